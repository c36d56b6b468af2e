"""Document quality by histogram gradient-boosted trees over text statistics.

The statistics of a text are counts and ratios over its bytes, words and lines. Trees are
grown in numpy on histograms of at most ``BINS`` bins a statistic, from at most
``TRAIN_ROWS`` labelled rows; they are kept as flat arrays, and all texts of a block walk a
tree together, one level a step.

Only the text is used. Defined cases: NULL and empty texts have all statistics at 0 and are scored
like any other; without labelled rows every score is 0.5; with one label only it is that
label. Repeated labels count as often as they come, NULL labels not at all. Other columns stay; own columns
replace columns of the same names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.rules import STOP_WORDS
from strata.llm.sampling import learnable, bounded
from strata.llm.textops import SPACE_WORDS, find_words, map_texts, prefix_hash, span_hash, word_grams

#: Bound of labelled rows to learn from.
TRAIN_ROWS = 20_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.2
MIN_ROWS = 10
GOOD_SCORE = 0.7

_STEP = np.uint64(0x9E3779B97F4A7C15)
_KINDS = {
    "letters": bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)),
    "capitals": bytes(range(65, 91)),
    "digits": b"0123456789",
    "symbols": b"#*$%&|<>@^~_=+\\/{}[]",
    "marks": b"!?",
    "stops": b".,;:",
    "controls": bytes(range(9)) + bytes(range(14, 32)) + b"\x7f",
}
NAMES = (
    "bytes words word_bytes long_words word_spread distinct_words common_words repeated_neighbours repeated_grams "
    "lines line_bytes repeated_lines ended_lines "
).split() + list(_KINDS)
_LINE = np.arange(256) != 10
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _common_hashes() -> np.ndarray:
    words = sorted({w.encode() for many in STOP_WORDS.values() for w in many})
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    return np.sort(span_hash(prefix_hash(data), np.r_[0, ends[:-1]], ends))


_COMMON = _common_hashes()


def _repeats(owner: np.ndarray, hashes: np.ndarray, count: int) -> np.ndarray:
    """Per text, how many values equal an earlier one."""
    keys = np.unique(hashes + owner.astype(np.uint64) * _STEP, return_index=True)[1]
    return np.bincount(owner, minlength=count) - np.bincount(owner[keys], minlength=count)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of figures per text, in the order of ``NAMES``."""
    count = len(offsets) - 1
    size = np.diff(offsets).astype(np.float64)
    starts, ends, firsts = find_words(data, offsets, SPACE_WORDS)
    words = np.diff(firsts).astype(np.float64)
    owner = np.repeat(np.arange(count), np.diff(firsts))
    length = (ends - starts).astype(np.float64)
    lowered = prefix_hash(_LOWER[data])
    hashes = span_hash(lowered, starts, ends)
    mean = np.bincount(owner, length, count) / np.maximum(words, 1)
    spread = np.sqrt(np.maximum(np.bincount(owner, length**2, count) / np.maximum(words, 1) - mean**2, 0))
    at = np.minimum(np.searchsorted(_COMMON, hashes), len(_COMMON) - 1)
    same = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]) if len(owner) else np.zeros(0, bool)
    grams, gram_owner, _ = word_grams(hashes, firsts, 3, short=False)
    line_starts, line_ends, line_firsts = find_words(data, offsets, _LINE)
    lines = np.diff(line_firsts).astype(np.float64)
    line_owner = np.repeat(np.arange(count), np.diff(line_firsts))
    line_hashes = span_hash(lowered, line_starts, line_ends)
    ended = np.isin(data[line_ends - 1], list(b".!?:;\"")) if len(line_ends) else np.zeros(0, bool)
    per_word = np.maximum(words, 1)
    figures = [
        np.log1p(size),
        np.log1p(words),
        mean,
        np.bincount(owner, length > 15, count) / per_word,
        spread,
        1 - _repeats(owner, hashes, count) / per_word,
        np.bincount(owner, _COMMON[at] == hashes, count) / per_word,
        np.bincount(owner[1:], same, count) / per_word if len(owner) else np.zeros(count),
        _repeats(gram_owner, grams, count) / per_word,
        np.log1p(lines),
        size / np.maximum(lines, 1),
        _repeats(line_owner, line_hashes, count) / np.maximum(lines, 1),
        np.bincount(line_owner, ended, count) / np.maximum(lines, 1),
    ]
    for kind in _KINDS.values():
        inside = np.zeros(256, bool)
        inside[list(kind)] = True
        run = np.append(0, np.cumsum(inside[data]))
        figures.append((run[offsets[1:]] - run[offsets[:-1]]) / np.maximum(size, 1))
    return np.stack(figures, axis=1)


@dataclass
class Forest:
    """All trees in flat arrays, a full binary tree of ``DEPTH`` levels each."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves

    def score(self, figures: np.ndarray) -> np.ndarray:
        total = np.full(len(figures), self.base)
        rows = np.arange(len(figures))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(figures), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (figures[rows, feature[node]] > threshold[node])
            total += value[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def grow(figures: np.ndarray, labels: np.ndarray) -> Forest:
    """Boost trees on the logistic loss; splits are found on histograms."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    none = (np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not len(labels):
        return Forest(0.0, *none)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(share / (1 - share)))
    if labels.min() == labels.max():
        return Forest(20.0 if labels[0] else -20.0, *none)
    cuts = [np.unique(np.quantile(figures[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(figures.shape[1])]
    bins = np.stack([np.searchsorted(c, figures[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    total = np.full(len(labels), base)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        odds = 1 / (1 + np.exp(-total))
        gradient, weight = labels - odds, np.maximum(odds * (1 - odds), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(labels), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best = np.full(width, 1e-9)
            cut_bin = np.full(width, BINS)
            split = np.zeros(width, np.int64)
            for f in range(figures.shape[1]):
                slot = (node - first) * BINS + bins[:, f]
                sums = [np.bincount(slot, w, width * BINS).reshape(width, BINS) for w in (gradient, weight, np.ones(len(labels)))]
                left = [np.cumsum(s, axis=1) for s in sums]
                right = [s[:, -1:] - s for s in left]
                gain = sum(g**2 / (h + 1) for g, h in ((left[0], left[1]), (right[0], right[1]))) - left[0][:, -1:] ** 2 / (left[1][:, -1:] + 1)
                gain[(left[2] < MIN_ROWS) | (right[2] < MIN_ROWS)] = 0
                at = gain[:, : len(cuts[f])].argmax(axis=1) if len(cuts[f]) else np.zeros(width, np.int64)
                top = gain[np.arange(width), at]
                better = top > best
                best[better], cut_bin[better], split[better] = top[better], at[better], f
            for n in range(width):
                feature[first + n] = split[n]
                if cut_bin[n] < BINS:
                    threshold[first + n] = cuts[split[n]][cut_bin[n]]
            node = 2 * node + 1 + (bins[np.arange(len(labels)), split[node - first]] > cut_bin[node - first])
        leaf = node - inner
        value = RATE * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, weight, leaves) + 1)
        total += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


def _with_statistics(docs: DataFrame, text: str) -> DataFrame:
    def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        figures = statistics(data, offsets)
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(figures) + 1) * figures.shape[1], pa.int32()), pa.array(figures.ravel()))]

    return map_texts(docs, text, [T.StructField("figures", T.ArrayType(T.DoubleType()))], work)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", rows: int = TRAIN_ROWS) -> Forest:
    """Learn from at most ``rows`` labelled ids that are not held out.

    An id with several labels has the greatest of them, one with several texts the least.
    """
    known = learnable(labels.select(key, label), key).groupBy(key).agg(F.max(label).alias(label)).where(F.col(label).isNotNull())
    chosen = bounded(known, known.count(), rows, key, label)
    texts = learnable(docs.select(key, text), key).join(chosen, key).groupBy(key, label).agg(F.min(text).alias(text))
    found = _with_statistics(texts, text).select("figures", label).collect()
    found = sorted((tuple(r.figures), int(r[label])) for r in found)
    return grow(np.array([f for f, _ in found]).reshape(-1, len(NAMES)), np.array([q for _, q in found], np.float64))


def score(docs: DataFrame, forest: Forest, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Documents with ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        scores = sent.value.score(statistics(data, offsets))
        return [pa.array(scores), pa.array((scores >= GOOD_SCORE).astype(np.int32))]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return map_texts(docs, text, fields, work, keep_text)
