"""Quality rules over documents in one projection of built-in functions.

A threshold table names ratios with their bounds; it is compiled to one condition over the
counted figures. Nothing leaves the JVM and nothing is shuffled.

Defined cases: a NULL text has no words and fails; so does any text of under 20 words.
Repeated rows are judged alike, other columns stay, and own columns replace columns of the
same names. Eight-word windows of one text are told apart by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

#: Fixed: white space between words, and symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
REPEAT_WINDOW = 8
#: Fixed word lists: frequent function words of four languages.
STOP_WORDS = {
    "en": "the be to of and that have with is was for it as are this by from at on in or an a".split(),
    "es": "el la los las de del que y en un una por con para se su es al no lo como o".split(),
    "fr": "le la les de des du et en un une que qui dans pour par sur au est ce se ne pas".split(),
    "de": "der die das und in den von zu mit ist des dem nicht ein eine auf für im es an als".split(),
}


@dataclass(frozen=True)
class Rule:
    """``low / 1000 <= part / whole <= high / 1000``; a bound may be absent."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None

    def condition(self) -> str:
        bounds = []
        if self.low is not None:
            bounds.append(f"1000 * {self.part} >= {self.low} * {self.whole}")
        if self.high is not None:
            bounds.append(f"1000 * {self.part} <= {self.high} * {self.whole}")
        return "(" + " and ".join(bounds) + ")"


#: Parts of a thousand.
RULES = (
    Rule("mean word length", "word_chars", "n_words", low=2_000, high=12_000),
    Rule("symbols per word", "n_symbols", "n_words", high=150),
    Rule("exclamation marks per word", "n_marks", "n_words", high=300),
    Rule("stop words per word", "n_stop_words", "n_words", low=30),
    Rule("repeated lines per line", "n_dup_lines", "n_lines", high=500),
)


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words(words: str) -> str:
    """Words inside windows found twice or more, from the hashes of a text's words."""
    size = REPEAT_WINDOW
    windows = f"transform(sequence(1, size(h) - {size - 1}), i -> xxhash64(slice(h, i, {size})))"
    pairs = "sort_array(transform(w, (x, i) -> struct(x as x, i as i)))"
    twice = (
        "filter(transform(s, (p, i) -> if((i > 0 and s[greatest(i - 1, 0)].x = p.x)"
        " or (i + 1 < size(s) and s[least(i + 1, size(s) - 1)].x = p.x), p.i, null)), p -> p is not null)"
    )
    sums = (
        f"aggregate(sort_array(at), struct(cast({-size} as int) as p, 0L as n),"
        f" (a, p) -> struct(p as p, a.n + least({size}, p - a.p) as n), a -> a.n)"
    )
    several = _let(pairs, "s", _let(twice, "at", sums))
    judged = _let(windows, "w", f"if(size(array_distinct(w)) = size(w), 0L, {several})")
    return _let(f"transform({words}, x -> xxhash64(x))", "h", f"if(size(h) < {size}, 0L, {judged})")


def _literal(text: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" if ord(c) < 32 or c in "\\'" else c for c in text) + "'"


def rule_columns(text: str = "text") -> tuple[dict, dict]:
    """The split text, and the figures that follow from it, as SQL expressions."""
    whole = f"coalesce(`{text}`, '')"
    stops = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words}))
    split = {
        "__words": f"array_remove(split({whole}, '[\\\\x20\\\\x09-\\\\x0D]+'), '')",
        "__lines": f"filter(split({whole}, '\\n', -1), l -> trim(both {_literal(SPACES)} from l) != '')",
    }
    figures = {
        "n_words": "cast(size(__words) as bigint)",
        "word_chars": f"cast(length(translate({whole}, {_literal(SPACES)}, '')) as bigint)",
        "n_symbols": f"cast(length({whole}) - length(translate({whole}, '{SYMBOLS}', '')) as bigint)",
        "n_dup_lines": "cast(size(__lines) - size(array_distinct(__lines)) as bigint)",
        "n_repeat_words": f"cast({_repeat_words('__words')} as bigint)",
        "n_lines": "cast(size(__lines) as bigint)",
        "n_marks": f"cast(length({whole}) - length(translate({whole}, '!', '')) as bigint)",
        "n_stop_words": f"cast(size(filter(__words, w -> lower(w) in ({stops}))) as bigint)",
    }
    return split, figures


BASE_FAILED = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 30 * n_words"


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Documents with the figures, ``base_failed`` and ``kept``."""
    split, figures = rule_columns(text)
    own = {*figures, "base_failed", "kept"}
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own - {text}]
    cut = docs.select(*others, *[F.expr(e).alias(n) for n, e in split.items()])
    counted = cut.select(*others, *[F.expr(e).alias(n) for n, e in figures.items()])
    verdict = " and ".join(["not base_failed", *[r.condition() for r in rules]])
    return counted.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", F.expr(verdict))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns only."""
    renamed = docs.withColumnsRenamed({c: f"__doc_{c}" for c in docs.columns if c != text})
    back = [F.col(f"`{c}`" if c == text else f"`__doc_{c}`").alias(c) for c in docs.columns]
    return judge(renamed, text, rules).where("kept").select(*back)
