"""Benchmark windows in documents, by a prefix-filtered set join.

A window is ``size`` consecutive words of a benchmark item, or all words of a shorter one.
A document that holds a window holds each of its shingles, so one shingle, the one that
the documents hold least often, is all that a window needs in the index. Places where a
document has such a shingle are candidates; the shingle's offset gives the only possible
start, windows that would run over either end of the text are dropped, and the rest are
compared word by word.

The index of at most ``INDEX_BYTES`` of benchmark text is broadcast. A larger benchmark is
dealt into parts by size, each of which is searched for by itself; the spans found are
brought together per text.

Defined cases: a NULL or empty text has no words and is clean; an item without words has no
windows; the windows of an item without an id hit words like any, but the item is not counted or
named; repeated items count once; repeated documents are each judged.
Other columns stay; own result columns replace columns of the same names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.textops import covered, find_words, map_texts, prefix_hash, ragged, span_hash, text_blocks, word_grams

#: Fixed: window length, and a document is contaminated if a twentieth of its words are hit.
WINDOW = 13
PART = 20
SHINGLE = 3
INDEX_BYTES = 16 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end and hash of each word, and each text's first word."""
    data = _LOWER[data]
    starts, ends, firsts = find_words(data, offsets, _IN_WORD)
    return data, starts, ends, firsts, span_hash(prefix_hash(data), starts, ends)


class WindowIndex:
    """Distinct windows of some items, and every shingle that may stand for one."""

    def __init__(self, items: list[tuple[object, str]], size: int = WINDOW) -> None:
        texts: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            raw = (text or "").encode()
            data, starts, ends, _, _ = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
            lowered = data.tobytes()
            words = [lowered[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            for at in range(max(1, len(words) - size + 1)) if words else ():
                texts.setdefault(tuple(words[at : at + size]), set()).update([] if item is None else [str(item)])
        self.windows = list(texts)
        self.owners = [sorted(texts[w]) for w in self.windows]
        self.lengths = np.array([len(w) for w in self.windows], np.int64)
        self.words = np.zeros((len(self.windows), size), np.uint64)
        keys, window, offset, width = [], [], [], []
        for n, words in enumerate(self.windows):
            blob = b"\n".join(words)
            data = np.frombuffer(blob, np.uint8)
            _, _, _, firsts, hashes = words_of(data, np.array([0, len(blob)]))
            self.words[n, : len(words)] = hashes
            shingle = min(SHINGLE, len(words))
            grams, _, places = word_grams(hashes, firsts, shingle)
            keys.extend(grams.tolist())
            window.extend([n] * len(grams))
            offset.extend(places.tolist())
            width.extend([shingle] * len(grams))
        self.keys, self.window = np.array(keys, np.uint64), np.array(window, np.int64)
        self.offset, self.width = np.array(offset, np.int64), np.array(width, np.int64)

    def shingles(self) -> dict[int, np.ndarray]:
        """The distinct shingles by their number of words."""
        return {int(w): np.unique(self.keys[self.width == w]) for w in np.unique(self.width)}

    def keep_rarest(self, seen: dict[tuple[int, int], int]) -> None:
        """Leave each window the shingle seen least often."""
        counts = np.array([seen.get((int(w), int(k)), 0) for w, k in zip(self.width, self.keys)], np.int64)
        order = np.lexsort((self.offset, self.keys, counts, self.window))
        first = order[np.r_[True, self.window[order][1:] != self.window[order][:-1]]] if len(order) else order
        first = first[np.lexsort((self.keys[first], self.width[first]))]
        self.keys, self.window, self.offset, self.width = (x[first] for x in (self.keys, self.window, self.offset, self.width))

    def find(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first and end word of each window occurrence, its number; words per text follow."""
        data, starts, ends, firsts, hashes = words_of(data, offsets)
        found: list[tuple[np.ndarray, ...]] = []
        for width in np.unique(self.width):
            own = np.flatnonzero(self.width == width)
            keys = self.keys[own]
            grams, texts, places = word_grams(hashes, firsts, int(width), short=False)
            low = np.searchsorted(keys, grams)
            hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == grams) if len(keys) else low[:0]
            counts = np.searchsorted(keys, grams[hit], "right") - low[hit]
            entry = own[ragged(low[hit], counts)]
            text, place = np.repeat(texts[hit], counts), np.repeat(places[hit], counts)
            window = self.window[entry]
            start = place - self.offset[entry]
            end = start + self.lengths[window]
            fits = (start >= firsts[text]) & (end <= firsts[text + 1])
            found.append(tuple(x[fits] for x in (text, start, end, window)))
        text, start, end, window = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]).astype(np.int64) for k in range(4))
        good = np.ones(len(start), bool)
        for k in range(self.words.shape[1]):
            inside = k < self.lengths[window]
            at = np.minimum(start + k, max(len(hashes) - 1, 0))
            good &= ~inside | (hashes[at] == self.words[window, k]) if len(hashes) else good
        text, start, end, window = text[good], start[good], end[good], window[good]
        lowered = data.tobytes()
        first, last = starts.tolist(), ends.tolist()
        exact = [
            all(lowered[first[a + k] : last[a + k]] == word for k, word in enumerate(self.windows[w]))
            for a, w in zip(start.tolist(), window.tolist())
        ]
        exact = np.array(exact, bool)
        return text[exact], start[exact] - firsts[text[exact]], end[exact] - firsts[text[exact]], window[exact], np.diff(firsts)


def _count_shingles(docs: DataFrame, text: str, index: WindowIndex) -> dict[tuple[int, int], int]:
    """How often the documents hold each of the index's shingles."""
    shingles = index.shingles()
    schema = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {w: np.zeros(len(k), np.int64) for w, k in shingles.items()}
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                *_, firsts, hashes = words_of(data, offsets)
                for width, keys in shingles.items():
                    grams, _, _ = word_grams(hashes, firsts, width, short=False)
                    at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
                    totals[width] += np.bincount(at[keys[at] == grams], minlength=len(keys))
        for width, keys in shingles.items():
            some = totals[width] > 0
            columns = [pa.array(np.full(int(some.sum()), width, np.int32)), pa.array(keys[some].view(np.int64)), pa.array(totals[width][some])]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    if not shingles:
        return {}
    counted = docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(run, schema).groupBy("width", "key").agg(F.sum("n").alias("n"))
    return {(r.width, r.key & (2**64 - 1)): r.n for r in counted.collect()}


def _indexes(docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, size: int, limit: int) -> Iterator[WindowIndex]:
    """One index, or several where the benchmark's text is over ``limit`` bytes."""
    items = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{item_text}`").alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = int(total // limit) + 1
    for part in range(parts):
        rows = items if parts == 1 else items.where(F.pmod(F.xxhash64("item", "t"), F.lit(parts)) == part)
        index = WindowIndex([(r.item, r.t) for r in rows.collect()], size)
        index.keep_rarest(_count_shingles(docs, text, index))
        yield index


_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
]


def _judged(words: list[int], hits: list[int], items: list[list[str]]) -> list[pa.Array]:
    return [
        pa.array(words, pa.int64()),
        pa.array(hits, pa.int64()),
        pa.array([len(i) for i in items], pa.int64()),
        pa.array(items, pa.list_(pa.string())),
        pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
        pa.array([h > 0 and PART * h >= w for w, h in zip(words, hits)], pa.bool_()),
    ]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW, keep_text: bool = True, limit: int = INDEX_BYTES
) -> DataFrame:
    """Documents with ``n_words``, ``n_hit``, ``n_items``, ``items``, ``items_sha256`` and ``contaminated``."""
    spark = docs.sparkSession
    indexes = [spark.sparkContext.broadcast(x) for x in _indexes(docs, benchmark, text, item, item_text, size, limit)]
    if len(indexes) == 1:
        sent = indexes[0]

        def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
            index = sent.value
            texts, start, end, window, words = index.find(data, offsets)
            firsts = np.append(0, np.cumsum(words))
            hit = covered(start + firsts[texts], end + firsts[texts], int(firsts[-1]))
            run = np.append(0, np.cumsum(hit))
            owners: list[set[str]] = [set() for _ in words]
            for t, w in set(zip(texts.tolist(), window.tolist())):
                owners[t].update(index.owners[w])
            return _judged(words.tolist(), np.diff(run[firsts]).tolist(), [sorted(o) for o in owners])

        return map_texts(docs, text, _FIELDS, work, keep_text)
    return _in_parts(docs, text, indexes, keep_text)


def _in_parts(docs: DataFrame, text: str, indexes: list, keep_text: bool) -> DataFrame:
    """Spans of every part's windows per text, brought together by the text's identity."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = docs.withColumn("__id", F.unhex(F.md5(whole)))
    distinct = named.select("__id", whole.alias("t")).dropDuplicates(["__id"])
    spans = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    fields = [T.StructField("words", T.LongType()), T.StructField("spans", spans), T.StructField("items", T.ArrayType(T.StringType()))]

    def search(sent):
        def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
            index = sent.value
            texts, start, end, window, words = index.find(data, offsets)
            cuts = [[] for _ in words]
            owners: list[set[str]] = [set() for _ in words]
            for t, a, b, w in set(zip(texts.tolist(), start.tolist(), end.tolist(), window.tolist())):
                cuts[t].append({"a": a, "b": b})
                owners[t].update(index.owners[w])
            kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            return [pa.array(words, pa.int64()), pa.array(cuts, kind), pa.array([sorted(o) for o in owners], pa.list_(pa.string()))]

        return map_texts(distinct, "t", fields, work)

    found = search(indexes[0])
    for sent in indexes[1:]:
        found = found.unionByName(search(sent))
    joined = found.groupBy("__id").agg(
        F.max("words").alias("__words"),
        F.flatten(F.collect_list("spans")).alias("__spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("__items"),
    )
    kept = [c for c in docs.columns if c not in {f.name for f in _FIELDS} and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in kept] + _FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, cuts, items = (batch.column(len(kept) + k).to_pylist() for k in range(3))
            hits = []
            for w, spans_ in zip(words, cuts):
                a, b = np.array([s["a"] for s in spans_], np.int64), np.array([s["b"] for s in spans_], np.int64)
                hits.append(int(covered(a, b, w).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(kept))] + _judged(words, hits, items), schema.names)

    picked = named.join(joined, "__id").select(*[F.col(f"`{c}`") for c in kept], "__words", "__spans", "__items")
    return picked.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The clean documents, with their own columns only."""
    judged = find_contamination(docs.withColumnsRenamed({c: f"__doc_{c}" for c in docs.columns if c != options.get("text", "text")}), benchmark, **options)
    back = [F.col(f"`{c}`" if c == options.get("text", "text") else f"`__doc_{c}`").alias(c) for c in docs.columns]
    return judged.where("not contaminated").select(*back)
