"""Near-duplicate documents by weighted-Jaccard signatures of their word shingles.

A document is a bag of five-word shingles. A shingle of weight w stands for the unit
intervals [0, w). Their Poisson processes are generated in dyadic blocks [0, 1), [1, 2),
[2, 4), [4, 8), ...: one process a block, at the block's rate, whose points beyond w are
dropped. Each point falls on one register; a register keeps its earliest point, and a
process stops when its next point comes after all registers' points. Two bags agree on
a register with the probability of their weighted Jaccard similarity, the sum of
the lesser weights over that of the greater.

Registers are banded. Texts that share a band are candidates. Within a band's bucket,
candidates are first held against one member; buckets that then hold several components
are compared inside tasks, which keep only the links that join components. A bucket too
large for a task is dealt into parts, and every two parts meet in a task of their own. Every
link is verified by the exact overlap of the bags.
Equal texts are one node. A class is a component of verified links; its id is the least
doc_id in it.

Defined cases: texts without words, NULL ones too, are classes of their own, told apart
by doc_id; a text of fewer than five words is one shingle; repeated rows share a class; a
NULL doc_id gives a NULL class only if no row of the class has an id. Other columns stay; the
class column replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.components import components
from strata.llm.store import stored
from strata.llm.textops import SPACE_WORDS, find_words, map_texts, mix, prefix_hash, ragged, span_hash, text_blocks, word_grams

SHINGLE = 5
#: Similarity that makes two documents near-duplicates, as a fraction.
SIMILAR = (4, 5)
BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
#: Of so many equal registers at least does a further pair become a candidate (0.6; the
#: standard error at a similarity of 0.8 is 0.04).
AGREEING = 58
#: Members, and shingles of all members, that one task compares, on the average of its buckets' parts.
SMALL_BUCKET = 2_000
BUCKET_SHINGLES = 2_000_000

_U64 = np.uint64
_SEED = _U64(0x2545F4914F6CDD1D)
_STEP = _U64(0x9E3779B97F4A7C15)


def bags(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, shingle and weight of each distinct shingle of each text."""
    starts, ends, firsts = find_words(data, offsets, SPACE_WORDS)
    hashes = span_hash(prefix_hash(data), starts, ends)
    grams, texts, _ = word_grams(hashes, firsts, SHINGLE)
    order = np.lexsort((grams, texts))
    grams, texts = grams[order], texts[order]
    new = np.flatnonzero(np.r_[True, (grams[1:] != grams[:-1]) | (texts[1:] != texts[:-1])]) if len(grams) else np.zeros(0, np.int64)
    return texts[new], grams[new], np.diff(np.append(new, len(grams)))


def _unit(values: np.ndarray) -> np.ndarray:
    return ((values >> _U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(texts: np.ndarray, grams: np.ndarray, weights: np.ndarray, count: int, registers: int = REGISTERS) -> np.ndarray:
    """One row of registers per text, 0 where a text has no shingle."""
    levels = np.ceil(np.log2(weights.astype(np.float64))).astype(np.int64) + 1  # blocks that weight w reaches
    element = np.repeat(np.arange(len(texts)), levels)
    level = ragged(np.zeros(len(levels), np.int64), levels)
    begin = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    size = np.where(level == 0, 1, begin)
    text, weight = texts[element], weights[element]
    seed = mix(grams[element] ^ (_SEED + level.astype(_U64) * _STEP))
    time = np.zeros(len(seed))
    best = np.full(count * registers, np.inf)
    who = np.zeros(count * registers, _U64)
    last = np.full(count, np.inf)
    draw = 0
    while len(seed):
        draw += 1
        point = mix(seed + _U64(draw * int(_STEP) & (2**64 - 1)))
        time = time - np.log(_unit(point)) / size
        live = time < last[text]
        if not live.all():
            seed, time, text, weight, begin, size, point = (x[live] for x in (seed, time, text, weight, begin, size, point))
        spot = mix(point ^ _SEED)
        register = text * registers + (spot % _U64(registers)).astype(np.int64)
        place = begin + (((spot >> _U64(20)) & (size.astype(_U64) - _U64(1)))).astype(np.int64)
        good = np.flatnonzero((place < weight) & (time < best[register]))
        good = good[np.argsort(-time[good], kind="stable")]
        best[register[good]] = time[good]
        who[register[good]] = point[good]
        touched = np.unique(text)
        rows = best.reshape(count, registers)
        last[touched] = rows[touched].max(axis=1) if len(touched) < count else rows.max(axis=1)
        keep = time < last[text]
        if not keep.all():
            seed, time, text, weight, begin, size = (x[keep] for x in (seed, time, text, weight, begin, size))
    return who.reshape(count, registers)


def _band_hashes(rows: np.ndarray) -> np.ndarray:
    """One hash a band and text."""
    hashes = np.zeros((len(rows), BANDS), _U64)
    for k in range(ROWS):
        hashes = mix(hashes ^ rows[:, k::ROWS]) + _STEP
    return mix(hashes + np.arange(BANDS, dtype=_U64))


def _signed(texts: DataFrame) -> DataFrame:
    """Node, bands and a byte of each register for texts that have shingles."""
    fields = [T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("bytes", T.BinaryType()), T.StructField("n_shingles", T.LongType())]

    def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        count = len(offsets) - 1
        texts_, grams, weights = bags(data, offsets)
        rows = signatures(texts_, grams, weights, count)
        some = np.bincount(texts_, minlength=count) > 0
        bands = _band_hashes(rows).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * BANDS, pa.int32()), pa.array(bands.ravel()), mask=pa.array(~some))
        sizes = np.bincount(texts_, weights, minlength=count).astype(np.int64)
        return [lists, pa.array([r.tobytes() for r in rows.astype(np.uint8)], pa.binary()), pa.array(sizes)]

    return map_texts(texts, "text", fields, work).where("bands is not null")


def overlaps(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of texts the sums of the lesser and of the greater weights."""
    less, more = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    begin = 0
    for row, end, data, offsets in text_blocks(left, 1 << 19):
        ta, ga, wa = bags(data, offsets)
        parts = []
        for r, e, d, o in text_blocks(right.slice(row, end - row), 1 << 22):
            tb, gb, wb = bags(d, o)
            parts.append((tb + r, gb, wb))
        tb, gb, wb = (np.concatenate([p[k] for p in parts]) for k in range(3))
        texts, grams = np.r_[ta, tb], np.r_[ga, gb]
        weights = np.r_[wa, wb]
        order = np.lexsort((grams, texts))
        texts, grams, weights = texts[order], grams[order], weights[order]
        same = np.flatnonzero((texts[1:] == texts[:-1]) & (grams[1:] == grams[:-1])) if len(texts) else np.zeros(0, np.int64)
        own = np.zeros(end - row, np.int64)
        np.add.at(own, texts[same], np.minimum(weights[same], weights[same + 1]))
        total = np.zeros(end - row, np.int64)
        np.add.at(total, texts, weights)
        less[row:end], more[row:end] = own, total - own
    return less, more


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts' bags overlap enough."""
    schema = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                less, more = overlaps(part.column(2), part.column(3))
                good = pa.array((less * SIMILAR[1] >= more * SIMILAR[0]) & (more > 0))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(good), part.column(1).filter(good)], schema.names)

    one = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    both = one.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInArrow(run, schema)


def _stars(members: DataFrame) -> DataFrame:
    """Every member of a bucket with the bucket's least member."""
    centre = members.groupBy("bucket").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return members.join(centre, "bucket").where("node != b").select(F.col("node").alias("a"), "b").distinct()


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members, with their components, of buckets that hold several components.

    ``parts`` tells in how many parts a bucket is dealt: one if a task may hold it.
    """
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    count, shingles = F.count(F.lit(1)), F.sum("n_shingles")
    # two parts meet in a task, so each is to be half of what a task may hold
    halves = F.ceil(F.greatest(count * 2 / SMALL_BUCKET, shingles * 2 / BUCKET_SHINGLES)).cast("int")
    parts = F.when((count <= SMALL_BUCKET) & (shingles <= BUCKET_SHINGLES), 1).otherwise(F.greatest(halves, F.lit(2)))
    several = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), parts.alias("parts")).where("lo != hi")
    return placed.join(several.select("bucket", "parts"), "bucket").select("bucket", "node", "root", "parts")


def _dealt(mixed: DataFrame) -> DataFrame:
    """Every member once for each two parts of its bucket that are to meet: ``x`` <= ``y``."""
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).otherwise(0)
    placed = mixed.distinct().withColumn("part", part)
    other = F.explode(F.expr("filter(sequence(0, parts - 1), p -> parts = 1 or p != part)"))
    met = placed.select("bucket", "node", "root", "part", other.alias("other"))
    return met.select("bucket", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "node", "root")


_PAIR = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of registers' bytes agree often enough to be worth a comparison."""
    return (x == y).sum(axis=-1) >= AGREEING


def _units(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
    """A text's shingles, each occurrence told apart, so bags overlap as these sets do."""
    texts, grams, weights = bags(data, offsets)
    occurrence = ragged(np.zeros(len(weights), np.int64), weights)
    units = mix(np.repeat(grams, weights) ^ (occurrence.astype(_U64) * _STEP))
    counts = np.bincount(np.repeat(texts, weights), minlength=len(offsets) - 1)
    return [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(units.view(np.int64)))]


def joining_pairs(roots: list[bytes], marks: np.ndarray, units: list[np.ndarray]) -> list[tuple[int, int]]:
    """Pairs of one bucket's members whose bags overlap enough, as few as join all that such pairs join."""
    own = np.unique(np.array([r.hex() for r in roots]), return_inverse=True)[1]
    sizes = np.array([len(u) for u in units])
    codes = np.unique(np.concatenate(units), return_inverse=True)[1]
    begins = np.cumsum(sizes) - sizes
    inside = np.zeros(len(codes), np.int32)
    found = []
    for n in range(1, len(own)):
        near = _agreeing(marks[:n], marks[n]) & (own[:n] != own[n])
        near &= np.minimum(sizes[:n], sizes[n]) * SIMILAR[1] >= np.maximum(sizes[:n], sizes[n]) * SIMILAR[0]
        some = np.flatnonzero(near)
        if not len(some):
            continue
        mine = codes[begins[n] : begins[n] + sizes[n]]
        inside[mine] = 1
        less = np.add.reduceat(inside[codes[ragged(begins[some], sizes[some])]], np.cumsum(sizes[some]) - sizes[some])
        inside[mine] = 0
        for m in some[less * SIMILAR[1] >= (sizes[some] + sizes[n] - less) * SIMILAR[0]].tolist():
            if own[m] != own[n]:
                found.append((m, n))
                own[own == own[m]] = own[n]
    return found


def _within(mixed: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified links of different components inside buckets."""
    own = signed.select("node", "bytes").join(mixed.select("node").distinct(), "node")
    units = map_texts(own.join(texts, "node"), "text", [T.StructField("units", T.ArrayType(T.LongType()))], _units, limit=1 << 18)
    rows = _dealt(mixed).join(units, "node").select("bucket", "x", "y", "node", "root", "bytes", "units")

    def link(held: list[tuple]) -> pa.RecordBatch:
        nodes, roots, marks, bags_ = zip(*held)
        pairs = joining_pairs(list(roots), np.frombuffer(b"".join(marks), np.uint8).reshape(len(marks), -1), list(bags_))
        return pa.RecordBatch.from_arrays([pa.array([nodes[p[k]] for p in pairs], pa.binary()) for k in (1, 0)], _PAIR.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        bucket = None
        for batch in batches:
            lists = batch.column(6)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            names = zip(*(batch.column(k).to_pylist() for k in range(6)))
            for row, (*place, node, root, marks) in enumerate(names):
                if place != bucket:
                    if len(held) > 1:
                        yield link(held)
                    bucket, held = place, []
                # a copy, so that a bucket held on to does not keep its batches
                held.append((node, root, marks, values[offsets[row] : offsets[row + 1]].copy()))
        if len(held) > 1:
            yield link(held)

    return rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y", "node").mapInArrow(run, _PAIR)


def near_duplicate_links(texts: DataFrame) -> DataFrame:
    """Verified links (a, b) that join all near-duplicates of ``node``, ``text`` rows.

    Links that only repeat what others already join are left out.
    """
    signed = stored(_signed(texts), "signatures")
    members = signed.select("node", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    links = stored(verified(_stars(members), texts), "verified")
    roots = stored(components(links), "roots")
    mixed = stored(_mixed(members, roots), "mixed")
    return links.unionByName(stored(_within(mixed, signed, texts), "verified"))


def _rooted(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents with ``__node`` and ``__words``, and the root of every linked node."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # a text without words is nobody's copy
    has_words = F.trim(whole, F.lit(" \t\n\x0b\x0c\r")) != ""
    named = docs.withColumns({"__node": F.unhex(F.md5(whole)), "__words": has_words})
    texts = named.where("__words").groupBy(F.col("__node").alias("node")).agg(F.first(whole).alias("text"))
    links = near_duplicate_links(stored(texts, "texts"))
    return named, components(links).select(F.col("node").alias("__node"), F.col("root").alias("__root"))


def classify(docs: DataFrame, text: str = "text", key: str = "doc_id", result: str = "class_id") -> DataFrame:
    """The documents with their class: the least key among near-duplicates of each other."""
    named, roots = _rooted(docs, text)
    ids = named.where("__words").groupBy("__node").agg(F.min(F.col(f"`{key}`")).alias("__least"))
    placed = ids.join(roots, "__node", "left").withColumn("__root", F.coalesce("__root", "__node"))
    least = placed.groupBy("__root").agg(F.min("__least").alias("__class"))
    classes = placed.join(least, "__root").select("__node", "__class")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != result]
    joined = named.join(classes, "__node", "left")
    return joined.select(*kept, F.when(F.col("__words"), F.col("__class")).otherwise(F.col(f"`{key}`")).alias(result))


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One document of each class: that with the least key, and among equals the least row.

    A row without a key comes after those that have one. Classes are told apart by their
    component, not by the key, so rows of one key but of different classes all stay. Rows
    without words are one class only if both key and text are equal.
    """
    named, roots = _rooted(docs, text)
    own = F.col("__words")
    placed = named.join(roots, "__node", "left").select(
        F.when(own, F.coalesce("__root", "__node")).alias("__root"),
        F.when(~own, F.col(f"`{key}`")).alias("__key"),
        F.when(~own, F.col(f"`{text}`")).alias("__text"),
        F.struct(F.col(f"`{key}`").isNull().alias("__no_key"), *[F.col(f"`{c}`") for c in [key, text, *(c for c in docs.columns if c not in (text, key))]]).alias("__row"),
    )
    first = placed.groupBy("__root", "__key", "__text").agg(F.min("__row").alias("r"))
    return first.select(*[F.col(f"r.`{c}`").alias(c) for c in docs.columns])
