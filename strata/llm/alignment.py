"""Alignment of two tokenizers' tokens by byte ranges, with corpus-wide counts of id pairs.

Both tokenizers encode a text; A sees the text behind one space, B adds that space itself. A
link is an overlap of an A token with a B token. Where tokens of both end, the text is cut
into groups. The boundaries of either side cut the text into ranges that lie in one A and
one B token each, so links are these ranges and need no comparison of tokens.

Texts are encoded word by word. A word begins with a space that follows a visible character;
neither tokenizer joins bytes across that place, which is looked up in their definitions;
where it does not hold, a text is one word. A task encodes a word once.

The index is inverted. Texts are gathered into containers of up to 65,536. For each
id pair, a container holds the bitmap of its texts, compressed: as 16-bit numbers where few
have the pair, as bits where many have it. Planes of bits tell how often each of them has it. Bitmaps
of one container are united while it fills; containers hold different texts, so their
population counts add up to a pair's number of documents. Counts go back to the
containers, where bitmaps and planes turn them into every text's sums.

Defined cases: a text that is NULL or empty, or whose tokens' bytes are not the text's, has no
tokens: all figures 0, the groups the empty string. Repeated rows count each. Names of special
tokens inside a text are plain text. Other columns stay, but for those named as results.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strata.llm.store import stored
from strata.llm.textops import ragged, text_blocks

#: Links and texts after which a container is closed; ordinals of texts take 16 bits.
CONTAINER_LINKS = 8_000_000
CONTAINER_TEXTS = 1 << 16
#: Id pairs of one stored row.
SEGMENT_PAIRS = 1 << 16
#: Bytes of different words that a task remembers, and that it encodes at once.
MEMORY_BYTES = 96 << 20
RUN_BYTES = 1 << 16

_SPACE = 0x20


class _Side:
    """One tokenizer: ids of a run of words, and each id's bytes."""

    def __init__(self, tokens: list[bytes], splits: bool) -> None:
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        #: whether no token holds a visible character before a space
        self.splits = splits

    def spelled(self, ids: np.ndarray) -> bytes:
        return self.bytes[ragged(self.begins[ids], self.sizes[ids])].tobytes()


class ByteLevel(_Side):
    """A byte-level BPE of the tokenizers library."""

    def __init__(self, definition: bytes) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition.decode())
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        # fixed: visible bytes stand for themselves, the others for characters from 256 on
        visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in visible]
        letters = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        names = [self.library.id_to_token(k) or "" for k in range(self.library.get_vocab_size())]
        tokens = [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names]
        kind = json.loads(definition).get("pre_tokenizer") or {}
        super().__init__(tokens, kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space"))

    def encode(self, words: bytes) -> np.ndarray:
        return np.array(self.library.encode(words.decode(), add_special_tokens=False).ids, np.int64)


class Pieces(_Side):
    """A sentencepiece model, which puts a space before a text."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = range(self.library.get_piece_size())
        names = [self.library.id_to_piece(k) for k in pieces]
        tokens = [bytes([int(n[3:-1], 16)]) if self.library.is_byte(k) else n.replace("▁", " ").encode() for k, n in zip(pieces, names)]
        super().__init__(tokens, not any(" " in t.lstrip(b" ").decode(errors="replace") for t in tokens))

    def encode(self, words: bytes) -> np.ndarray:
        return np.array(self.library.encode(words[1:].decode(), num_threads=1), np.int64)


def word_begins(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """First byte of each word: texts' begins, and spaces after a visible character.

    A character of several bytes that could be a blank one counts as blank.
    """
    at = np.flatnonzero(data == _SPACE)
    at = at[at >= 3]
    one, two, three = (data[at - k] for k in (1, 2, 3))
    visible = (one > 0x20) & (one != 0x7F)
    visible &= ~((two == 0xC2) & (one >= 0x80))
    visible &= ~((one >= 0x80) & np.isin(three, (0xE1, 0xE2, 0xE3)) & np.isin(two, (0x80, 0x81, 0x9A)))
    first = np.zeros(len(data), bool)
    first[at[visible]] = True
    first[begins] = True
    return np.flatnonzero(first)


class Words:
    """Every word's groups and links, encoded once; forgotten when they take too many bytes.

    A word's index leads to its slice of ``pairs`` (an id pair a link), its figures (A tokens,
    B tokens, groups, links, and whether its tokens spell it) and its groups as text.
    """

    def __init__(self, a: _Side, b: _Side) -> None:
        self.a, self.b = a, b
        self.wide = len(b.sizes)
        #: every id in decimal, with a sign behind it
        numbers = [b"%d," % k for k in range(max(len(a.sizes), self.wide))]
        self.decimals = _Side(numbers, True)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.held = 0
        self.pairs = [np.zeros(0, np.int64)]
        self.figures = [np.zeros((0, 5), np.int64)]

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """Index of each of the given different words."""
        new = [w for w in words if w not in self.known]
        if self.held > MEMORY_BYTES:
            self.forget()
            new = words
        run: list[bytes] = []
        size = 0
        for word in new:
            if size and (size + len(word) > RUN_BYTES or not self._joins(run[-1])):
                self._learn(run)
                run, size = [], 0
            run.append(word)
            size += len(word)
        if run:
            self._learn(run)
        return np.array([self.known[w] for w in words], np.int64)

    def _joins(self, word: bytes) -> bool:
        """Whether another word may follow in one run: the word ends visibly."""
        if not (self.a.splits and self.b.splits):
            return False
        last = word[-1]
        if last < 0x80:
            return last > 0x20 and last != 0x7F
        return word[-2] != 0xC2 and not (word[-3] in (0xE1, 0xE2, 0xE3) and word[-2] in (0x80, 0x81, 0x9A))

    def _learn(self, run: list[bytes]) -> None:
        whole = b"".join(run)
        ids = [self.a.encode(whole), self.b.encode(whole)]
        ends = [np.cumsum(side.sizes[i]) for side, i in zip((self.a, self.b), ids)]
        word_ends = np.cumsum([len(w) for w in run])
        spelled = all(side.spelled(i) == whole for side, i in zip((self.a, self.b), ids))
        if spelled and all(np.isin(word_ends, e).all() for e in ends):
            return self._keep(run, ids, ends, word_ends)
        if len(run) > 1:
            for word in run:
                self._learn([word])
            return None
        return self._keep(run, [np.zeros(0, np.int64)] * 2, [np.zeros(0, np.int64)] * 2, word_ends, spelled=False)

    def _keep(self, run: list[bytes], ids: list[np.ndarray], ends: list[np.ndarray], word_ends: np.ndarray, spelled: bool = True) -> None:
        links = np.union1d(*ends)
        cuts = np.intersect1d(*ends, assume_unique=True)
        first = [np.searchsorted(e, links) for e in ends]
        self.pairs.append(ids[0][first[0]] * self.wide + ids[1][first[1]])
        counted = [np.searchsorted(e, word_ends, "right") for e in (*ends, cuts, links)]
        figures = np.stack([np.diff(np.append(0, c)) for c in counted] + [np.full(len(run), spelled)], axis=1).astype(np.int64)
        self.figures.append(figures)
        text, text_ends = self._as_text(ids, ends, cuts)
        last = text_ends[counted[2] - 1] if len(cuts) else np.zeros(len(run), np.int64)
        begin = 0
        for word, end in zip(run, last.tolist()):
            self.known[word] = len(self.texts)
            self.texts.append(text[begin : max(end - 1, begin)])
            begin = end
        self.held += int(word_ends[-1]) + 9 * len(links) + 120 * len(run)

    def _as_text(self, ids: list[np.ndarray], ends: list[np.ndarray], cuts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;`` for each group in a row, and where each group's text ends."""
        group = np.concatenate([np.searchsorted(cuts, e) for e in ends])
        side = np.repeat([0, 1], [len(i) for i in ids])
        order = np.lexsort((side, group))
        group, side, numbers = group[order], side[order], np.concatenate(ids)[order]
        stops = np.cumsum(self.decimals.sizes[numbers])
        text = self.decimals.bytes[ragged(self.decimals.begins[numbers], self.decimals.sizes[numbers])]
        ending = np.r_[(group[1:] != group[:-1]) | (side[1:] != side[:-1]), True] if len(group) else np.zeros(0, bool)
        text[stops[ending] - 1] = np.where(side[ending] == 0, ord("|"), ord(";"))
        return text.tobytes(), stops[ending & (side == 1)]

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs, each word's first one, and all figures."""
        for name in ("pairs", "figures"):
            kept = getattr(self, name)
            if len(kept) > 1:
                setattr(self, name, [np.concatenate(kept)])
        counts = self.figures[0][:, 3]
        return self.pairs[0], np.cumsum(counts) - counts, self.figures[0]


class Container:
    """Links of up to ``CONTAINER_TEXTS`` texts, given out as segments of the inverted index."""

    def __init__(self) -> None:
        self.links: list[np.ndarray] = []
        self.n_links = self.n_texts = 0

    def add(self, texts: int, pairs: np.ndarray, owner: np.ndarray) -> None:
        self.links.append((pairs << 16) | (owner + self.n_texts))
        self.n_links += len(pairs)
        self.n_texts += texts

    def segments(self) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, bytes]]:
        """Pairs, their population counts, compressed bitmaps and multiplicity planes."""
        keys = np.sort(np.concatenate(self.links)) if self.links else np.zeros(0, np.int64)
        self.links = []
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(keys)))
        keys = keys[new]
        pairs, texts = keys >> 16, keys & 0xFFFF
        begins = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]) if len(keys) else np.zeros(0, np.int64)
        counts = np.diff(np.append(begins, len(keys)))
        for at in range(0, len(begins), SEGMENT_PAIRS):
            some = slice(at, at + SEGMENT_PAIRS)
            yield pairs[begins[some]], counts[some], *self._packed(texts, times, begins[some], counts[some])

    def _packed(self, texts: np.ndarray, times: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
        order, many = packing_order(counts, self.n_texts)
        place = ragged(begins[order], counts[order])
        few = int(counts[order[: len(order) - many]].sum())
        bits = np.zeros((many, bitmap_bytes(self.n_texts) * 8), np.uint8)
        bits[np.repeat(np.arange(many), counts[order[len(order) - many :]]), texts[place[few:]]] = 1
        docs = texts[place[:few]].astype("<u2").tobytes() + np.packbits(bits, axis=1, bitorder="little").tobytes()
        own = times[place]
        planes = [np.packbits((own >> k & 1).astype(np.uint8), bitorder="little").tobytes() for k in range(int(own.max()).bit_length())]
        return docs, b"".join(planes)


def bitmap_bytes(texts: int) -> int:
    return -(-texts // 8)


def packing_order(counts: np.ndarray, texts: int) -> tuple[np.ndarray, int]:
    """Pairs kept as numbers, then those kept as bits, and how many the latter are."""
    dense = counts * 2 > bitmap_bytes(texts)
    return np.argsort(dense, kind="stable"), int(dense.sum())


def unpacked(counts: np.ndarray, docs: bytes, planes: bytes, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pair, text and multiplicity of every posting of a segment."""
    order, many = packing_order(counts, texts)
    sizes = counts[order]
    few = int(sizes[: len(order) - many].sum())
    numbers = np.frombuffer(docs, "<u2", few).astype(np.int64)
    bits = np.frombuffer(docs, np.uint8, offset=2 * few).reshape(many, -1) if many else np.zeros((0, 1), np.uint8)
    place = np.r_[numbers, np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))[1]]
    total = len(place)
    times = np.zeros(total, np.int64)
    for k, at in enumerate(range(0, len(planes), -(-total // 8))):
        plane = np.frombuffer(planes, np.uint8, -(-total // 8), at)
        times += np.unpackbits(plane, count=total, bitorder="little").astype(np.int64) << k
    return np.repeat(order, sizes), place, times


_tokenizers: dict[str, tuple[_Side, _Side]] = {}


def _sides(definitions: tuple[bytes, bytes]) -> tuple[_Side, _Side]:
    """The worker's tokenizers, made once a process."""
    name = hashlib.sha256(b"".join(definitions)).hexdigest()
    if name not in _tokenizers:
        _tokenizers[name] = ByteLevel(definitions[0]), Pieces(definitions[1])
    return _tokenizers[name]


def aligned_block(words: Words, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Figures (A, B, groups, links) and groups of each text, and pair and text of each link."""
    count = len(offsets) - 1
    some = np.flatnonzero(np.diff(offsets) > 0)
    spaced = np.insert(data, offsets[some], _SPACE)
    begins = offsets[some] + np.arange(len(some))
    firsts = word_begins(spaced, begins) if words.a.splits and words.b.splits else begins
    cuts = pa.py_buffer(np.append(firsts, len(spaced)).astype(np.int64))
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(firsts), [None, cuts, pa.py_buffer(np.ascontiguousarray(spaced))]).dictionary_encode()
    index = words.look_up(coded.dictionary.to_pylist())
    code = index[coded.indices.to_numpy()] if len(firsts) else np.zeros(0, np.int64)
    pairs, first_pair, all_figures = words.tables()
    owner = some[np.searchsorted(begins, firsts, "right") - 1] if len(firsts) else np.zeros(0, np.int64)
    bad = np.zeros(count, bool)
    bad[owner[all_figures[code, 4] == 0]] = True
    good = ~bad[owner]
    code, owner = code[good], owner[good]
    figures = np.zeros((count, 4), np.int64)
    np.add.at(figures, owner, all_figures[code, :4])
    named = list(map(words.texts.__getitem__, code.tolist()))
    stops = np.searchsorted(owner, np.arange(count + 1)).tolist()
    groups = [b";".join(named[i:j]) for i, j in zip(stops, stops[1:])]
    links = all_figures[code, 3]
    return figures, groups, pairs[ragged(first_pair[code], links)], np.repeat(owner, links)


_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
_INDEX = [
    T.StructField("__container", T.LongType()),
    T.StructField("__text", T.LongType()),
    T.StructField("__texts", T.LongType()),
    T.StructField("__segment", T.LongType()),
    T.StructField("__pairs", T.ArrayType(T.LongType())),
    T.StructField("__counts", T.ArrayType(T.LongType())),
    T.StructField("__docs", T.BinaryType()),
    T.StructField("__planes", T.BinaryType()),
]


def _indexed(docs: DataFrame, definitions: tuple[bytes, bytes], text: str, digests: bool) -> DataFrame:
    """Rows of texts (no ``__segment``) and rows of the inverted index, stored together."""
    spark = docs.sparkSession
    box = spark.sparkContext.broadcast(definitions)  # two vocabulary files, a few MB whatever the corpus
    result = "groups_sha256" if digests else "groups"
    own = {*_FIGURES, result, "n_best", "count_sum"}
    kept = [c for c in docs.columns if c not in own and c != text]
    nullable = [T.StructField(c, docs.schema[c].dataType) for c in kept]
    schema = T.StructType(nullable + [T.StructField(c, T.LongType()) for c in _FIGURES] + [T.StructField(result, T.StringType())] + _INDEX)

    def texts_batch(columns: list[pa.Array], figures: np.ndarray, groups: list[bytes], container: int, first: int) -> pa.RecordBatch:
        count = len(groups)
        if digests:
            groups = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(groups, figures[:, 0].tolist())]
        else:
            groups = [g.decode() for g in groups]
        index = [pa.array(np.full(count, container)), pa.array(np.arange(first, first + count))] + [pa.nulls(count, t) for t in index_types[2:]]
        return pa.RecordBatch.from_arrays(columns + [pa.array(figures[:, k]) for k in range(4)] + [pa.array(groups, pa.string())] + index, schema.names)

    index_types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.binary()] * 2

    def segment_batches(held: Container, container: int, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        texts = held.n_texts
        for n, (pairs, counts, names, planes) in enumerate(held.segments()):
            empty = [pa.nulls(1, t) for t in types + [pa.int64()] * 4 + [pa.string()]]
            index = [[container], [None], [texts], [n], [pairs], [counts], [names], [planes]]
            yield pa.RecordBatch.from_arrays(empty + [pa.array(v, t) for v, t in zip(index, index_types)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(*_sides(box.value))
        number = TaskContext.get().partitionId() << 24
        held, types = Container(), []
        for batch in batches:
            types = [batch.column(k).type for k in range(len(kept))]
            for row, end, data, offsets in text_blocks(batch.column(len(kept)), 1 << 21):
                if held.n_links >= CONTAINER_LINKS or held.n_texts + end - row > CONTAINER_TEXTS:
                    yield from segment_batches(held, number, types)
                    held, number = Container(), number + 1
                figures, groups, pairs, owner = aligned_block(words, data, offsets)
                columns = [batch.column(k).slice(row, end - row) for k in range(len(kept))]
                yield texts_batch(columns, figures, groups, number, held.n_texts)
                held.add(end - row, pairs, owner)
        yield from segment_batches(held, number, types)

    chosen = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))
    return stored(chosen.mapInArrow(run, schema), "index")


def _light(index: DataFrame) -> DataFrame:
    """A row for every pair of every segment: the place in it and the population count."""
    entry = F.posexplode(F.arrays_zip(F.col("__pairs").alias("p"), F.col("__counts").alias("n"))).alias("place", "e")
    rows = index.where("__segment is not null").select("__container", "__segment", entry)
    return rows.select("__container", "__segment", F.col("place").cast("long").alias("place"), F.col("e.p").alias("pair"), F.col("e.n").alias("n"))


def _counted(light: DataFrame, wide: int) -> DataFrame:
    """``pair``, its number of documents and whether no pair of its A id has more."""
    counts = light.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.expr(f"pair div {wide}"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


_SCORES = T.StructType([T.StructField(c, T.LongType()) for c in ("__container", "__text", "n_best", "count_sum")])


def _returned(index: DataFrame, light: DataFrame, scored: DataFrame) -> DataFrame:
    """Each text's sums, from its container's bitmaps and the counts that came back to them."""
    back = light.join(scored, "pair").select("__container", "__segment", "place", "count", "best")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("__texts", "long"), ("__counts", "array<bigint>"), ("__docs", "binary"), ("__planes", "binary"))]
    numbers = back.select("__container", "__segment", "place", "count", "best", *nothing)
    no_number = [F.lit(-1).cast("long").alias("place"), F.lit(0).cast("long").alias("count"), F.lit(0).cast("long").alias("best")]
    segments = index.where("__segment is not null").select("__container", "__segment", *no_number, "__texts", "__counts", "__docs", "__planes")

    def sums(container: int, segment: tuple, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        texts, counts, docs, planes = segment
        pair, text, times = unpacked(counts, docs, planes, texts)
        found = np.zeros((2, texts), np.int64)
        for k, part in enumerate((1, 0)):
            np.add.at(found[k], text, times * np.concatenate([p[part] for p in parts])[pair])
        some = np.flatnonzero(found[1])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(some), container)), pa.array(some), pa.array(found[0][some]), pa.array(found[1][some])], _SCORES.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        container, segment, parts = 0, None, []
        for batch in batches:
            place = batch.column(2).to_numpy()
            heads = np.flatnonzero(place < 0).tolist()
            numbers = [batch.column(k).to_numpy() for k in (3, 4)]
            for begin, end in zip([-1, *heads], [*heads, len(batch)]):
                if begin >= 0:
                    if segment:
                        yield sums(container, segment, parts)
                    container, parts = batch.column(0)[begin].as_py(), []
                    segment = tuple(batch.column(k)[begin].as_py() for k in (5, 6, 7, 8))
                    segment = (segment[0], np.array(segment[1], np.int64), *segment[2:])
                if end > begin + 1:
                    parts.append(tuple(n[begin + 1 : end] for n in numbers))
        if segment:
            yield sums(container, segment, parts)

    dealt = segments.unionByName(numbers).repartition("__container", "__segment").sortWithinPartitions("__container", "__segment", "place")
    return dealt.mapInArrow(run, _SCORES).groupBy("__container", "__text").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def _definitions(path_a: str, path_b: str) -> tuple[bytes, bytes]:
    with open(path_a, "rb") as a, open(path_b, "rb") as b:
        return a.read(), b.read()


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", digests: bool = False) -> DataFrame:
    """The documents with their figures and their groups, ``a1,a2|b1;a3|b2``; the text is left out.

    ``n_best`` counts links whose pair no other pair of the A id exceeds in documents,
    ``count_sum`` adds up the pairs' numbers of documents over all links. With ``digests``,
    the groups are given by their SHA-256.
    """
    definitions = _definitions(path_a, path_b)
    index = _indexed(docs, definitions, text, digests)
    light = _light(index)
    scores = _returned(index, light, _counted(light, len(Pieces(definitions[1]).sizes)))
    own = {f.name for f in _INDEX}
    texts = index.where("__segment is null").drop(*(own - {"__container", "__text"}))
    found = texts.join(scores, ["__container", "__text"], "left")
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return found.select(*[F.col(f"`{c}`") for c in texts.columns if c not in own], *sums)


def pair_counts(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """``a_id``, ``b_id``, documents that link them and links, of every id pair of the corpus."""
    definitions = _definitions(path_a, path_b)
    index = _indexed(docs, definitions, text, digests=True)
    wide = len(Pieces(definitions[1]).sizes)
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("pair", "n_docs", "n_links")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, pairs, counts, names, planes in zip(*(batch.column(k).to_pylist() for k in range(5))):
                counts = np.array(counts, np.int64)
                pair, _, times = unpacked(counts, names, planes, texts)
                links = np.zeros(len(counts), np.int64)
                np.add.at(links, pair, times)
                yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(counts), pa.array(links)], schema.names)

    segments = index.where("__segment is not null").select("__texts", "__pairs", "__counts", "__docs", "__planes")
    summed = segments.mapInArrow(run, schema).groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    return summed.select(F.expr(f"pair div {wide}").alias("a_id"), (F.col("pair") % wide).alias("b_id"), "n_docs", "n_links")
