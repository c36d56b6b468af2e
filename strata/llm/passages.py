"""Near-duplicate passages, by compact windows of min-hashed word shingles.

A text is a sequence of five-word shingles. For each of ``HASHES`` hash functions the shingles'
values form a Cartesian tree, whose nodes are compact windows (l, c, r): every passage that
begins in [l, c] and ends in [c, r] has its least value at c. Windows too short for a
passage are left out, so there are about two windows per passage length and function.

Equal passages come first, by the first function alone: they lie in windows of one value, at one
distance from c. Equal windows repeat as a whole; of unequal ones of a value, passages are grouped
by a hash of their shingles. This takes no pairs of windows.

For the rest, function after function, of equal windows the first and last are kept, and values are
left out whose windows are known and of one component. All windows of a value then meet inside tasks, many
values in one array, but for those pairs that can add nothing: of one component, and with all
their passages found. Here one function is enough, and passages that met by an earlier one do not
meet again. A passage drops out if too few of its shingles are in other windows of the value; those
alike but for shingles of their own alone are found by a hash of the others; then windows with enough
shingles in common are compared where the value lies in one column, and only what is open after
that in all alignments. Similar is what the shingles' Jaccard similarity says. A value of too many windows for
a task is dealt into parts, and every two parts meet in a task of their own. Only passages that join texts or
are new leave a task. In the end all of them grow on both sides as long as the words agree.

Equal texts are one text of several copies; all its words are then repeated if they are enough for a passage.

Defined cases: NULL and empty texts, and texts shorter than a passage, have no passages; a
passage may repeat in its own text; repeated rows are copies. ``find`` keeps other
columns; its own columns replace columns of the same names. A class is a
component of texts that share a passage, named by the least doc_id in it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from strata.llm.components import components
from strata.llm.store import stored
from strata.llm.textops import SPACE_WORDS, covered, find_words, mix, prefix_hash, ragged, span_hash, text_blocks, word_grams

SHINGLE = 5
#: Words of the shortest passage, and the shingles they make.
PASSAGE = 50
SPAN = PASSAGE - SHINGLE + 1
#: So that at a similarity of 0.8 no function agrees with probability 0.2 ** 6, 0.006 %.
HASHES = 6
SIMILAR = (4, 5)
#: Windows of one value that one task compares, on each side, and windows of several values compared at once.
PART_WINDOWS = 4_000
MEET_WINDOWS = 2_000
#: Characters, times functions, whose windows make one bin, and windows that a task holds before it deals them.
BIN_CHARS = 16_000_000
HELD_WINDOWS = 500_000
#: Windows whose common shingles are counted by one product of matrices, and pairs of windows compared at a time.
DENSE_WINDOWS = 48
HELD_PAIRS = 32_768
#: Remainders by which windows are told to lack a shingle.
RESTS = 2_048

_U64 = np.uint64
_SEED = _U64(0xD6E8FEB86659FD93)
#: Bits of a key that tell its hash function.
_FUNCTION = 7


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


def shingles_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of all texts in a row, where each text's begin, and words per text."""
    starts, ends, firsts = find_words(data, offsets, SPACE_WORDS)
    hashes = span_hash(prefix_hash(data), starts, ends)
    grams, texts, _ = word_grams(hashes, firsts, SHINGLE, short=False)
    return grams, np.searchsorted(texts, np.arange(len(offsets))), np.diff(firsts)


def compact_windows(values: np.ndarray, firsts: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """l, c and r of every window at least ``span`` wide; ties go to the left.

    A node that wide is the leftmost least of some run of ``span`` values, so only those
    are looked at, and its neighbours in the tree are among them too.
    """
    sizes = np.diff(firsts)
    counts = np.maximum(sizes - span + 1, 0)
    begins = ragged(firsts[:-1], counts)
    if not len(begins):
        return (np.zeros(0, np.int64),) * 3
    # leftmost least by blocks: ranks order values first and places second
    order = np.argsort(values, kind="stable")
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    low, size = rank, 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    place = order[low[begins]]
    text = np.repeat(np.arange(len(sizes)), counts)
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    nodes, owner = place[new], text[new]
    ranks = rank[nodes].tolist()
    left, right = firsts[:-1][owner], firsts[1:][owner] - 1
    before, after = left.tolist(), right.tolist()
    places, owners = nodes.tolist(), owner.tolist()
    stack: list[int] = []
    for n, r in enumerate(ranks):
        if stack and owners[stack[-1]] != owners[n]:
            stack.clear()
        while stack and ranks[stack[-1]] > r:
            after[stack.pop()] = places[n] - 1
        if stack:
            before[n] = places[stack[-1]] + 1
        stack.append(n)
    return np.array(before), nodes, np.array(after)


def least_of_spans(low: np.ndarray) -> np.ndarray:
    """The least of each ``SPAN`` values in a row."""
    size = 1
    while size * 2 <= SPAN:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    return np.minimum(low[: len(low) - (SPAN - size)], low[SPAN - size :])


def passage_windows(values: np.ndarray, firsts: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First begin, c and last begin of the passages of ``span`` values in every compact window.

    All passages with their least value at c begin in one run, so no tree is to be built.
    Values are told apart by the bits above those of a place.
    """
    counts = np.maximum(np.diff(firsts) - span + 1, 0)
    begins = ragged(firsts[:-1], counts)
    if not len(begins):
        return (np.zeros(0, np.int64),) * 3
    bits = _U64(len(values).bit_length())
    low, size = values >> bits << bits | np.arange(len(values), dtype=_U64), 1
    while size * 2 <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < span:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    place = (low[begins] & ((_U64(1) << bits) - _U64(1))).astype(np.int64)
    new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return begins[new], place[new], begins[np.r_[new[1:], len(begins)] - 1]


def min_hashes(grams: np.ndarray, k: int) -> np.ndarray:
    """The values of function ``k``, different for different shingles."""
    return mix(grams ^ _U64(int(_SEED) * (2 * k + 3) & (2**64 - 1)))


def run_hashes(grams: np.ndarray) -> np.ndarray:
    """A hash of the shingles of each passage, in their order."""
    size, factor = 1, _U64(0x9E3779B97F4A7C15)
    if len(grams) < SPAN:
        return np.zeros(0, _U64)
    while size * 2 <= SPAN:
        grams = mix(grams[:-size] * factor ^ grams[size:] + _U64(size))
        size *= 2
    return mix(grams[: len(grams) - (SPAN - size)] * factor ^ grams[SPAN - size :] + _U64(SPAN))


#: A window: ``content`` is of all its shingles and c, ``found`` tells that all its passages are known.
_WINDOW = np.dtype(
    [(n, np.int64) for n in ("key", "content", "u", "root")] + [(n, np.int32) for n in ("l", "c", "r")] + [("found", np.bool_)]
)


def _no_spans() -> Column:
    return F.expr("cast(array() as array<struct<begin: bigint, end: bigint>>)")


def _known_begins(spans: pa.Array, row: int, end: int, firsts: np.ndarray, size: int) -> np.ndarray:
    """Of all shingles of a block of texts, those where a known passage begins."""
    places = spans.offsets.to_numpy()[row : end + 1]
    begins, ends = (x.to_numpy()[places[0] : places[-1]] for x in spans.values.flatten())
    at = np.repeat(firsts[:-1], np.diff(places))
    return covered(at + begins, at + ends - SPAN + 1, size)


def _windows_of(row: int, end: int, data: np.ndarray, offsets: np.ndarray, names: np.ndarray, roots: np.ndarray, spans: pa.Array, functions: range) -> Iterator[np.ndarray]:
    """Windows of a block of texts."""
    grams, firsts, _ = shingles_of(data, offsets)
    runs = run_hashes(grams)
    owner = np.repeat(np.arange(row, end), np.diff(firsts))
    unknown = np.append(0, np.cumsum(~_known_begins(spans, row, end, firsts, len(grams))))
    for k in functions:
        values = min_hashes(grams, k)
        low, c, high = passage_windows(values, firsts)
        made = np.zeros(len(c), _WINDOW)
        made["key"] = (mix(values[c]) & _U64(~_FUNCTION & (2**64 - 1)) | _U64(k)).view(np.int64)
        shape = mix(((c - low) * SPAN + high - low).astype(_U64))
        made["content"] = mix(mix(runs[low] ^ shape) + runs[high]).view(np.int64)
        made["u"], made["root"] = names[owner[c]], roots[owner[c]]
        at = firsts[owner[c] - row]
        made["l"], made["c"], made["r"] = low - at, c - at, high + SPAN - 1 - at
        made["found"] = unknown[high + 1] == unknown[low]
        yield made


def _named(texts: DataFrame, known: DataFrame | None) -> DataFrame:
    """Texts with the least one of their component and what is known of them."""
    if known is None:
        return texts.select("u", F.col("u").alias("root"), _no_spans().alias("spans"), "text")
    return texts.join(known.hint("shuffle_hash"), "u", "left").select("u", F.coalesce("root", "u").alias("root"), F.coalesce("spans", _no_spans()).alias("spans"), "text")


def _dealt(texts: DataFrame, known: DataFrame | None, functions: range, chars: int) -> DataFrame:
    """Windows packed into rows by bins of keys, each bin's together."""
    bins = 1 + chars * len(functions) // BIN_CHARS
    named = _named(texts, known)

    def split(held: list[np.ndarray]) -> pa.RecordBatch:
        made = np.concatenate(held)
        place = ((made["key"].view(_U64) >> _U64(3)) % _U64(bins)).astype(np.int64)
        made = made[np.argsort(place, kind="stable")]
        counts = np.bincount(place, minlength=bins)
        ends = np.cumsum(counts)
        some = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays([pa.array(some), pa.array([made[e - n : e].tobytes() for e, n in zip(ends[some], counts[some])], pa.binary())], ["bin", "windows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            names, roots = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, end, data, offsets in text_blocks(batch.column(3)):
                held += _windows_of(row, end, data, offsets, names, roots, batch.column(2), functions)
                if sum(map(len, held)) > HELD_WINDOWS:
                    yield split(held)
                    held = []
        if held:
            yield split(held)

    packed = named.mapInArrow(run, T.StructType([*_long("bin"), T.StructField("windows", T.BinaryType())]))
    return packed.repartition("bin").sortWithinPartitions("bin")


def _bins(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """All windows of one bin after another."""
    held: list[bytes] = []
    group = None
    for batch in batches:
        for name, raw in zip(*(batch.column(k).to_pylist() for k in (0, 1))):
            if name != group and held:
                yield np.frombuffer(b"".join(held), _WINDOW)
                held = []
            group = name
            held.append(raw)
    if held:
        yield np.frombuffer(b"".join(held), _WINDOW)


def partners(starts: np.ndarray, counts: np.ndarray, texts: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Of equal passages, which lie in runs ordered by text and begin, one that each repeats, or -1.

    This is the first or the last one; others would not do where these overlap it.
    """
    every = np.arange(len(texts))
    got = np.full(len(texts), -1)
    for ends in (starts + counts - 1, starts):
        other = np.repeat(ends, counts)
        good = (texts[other] != texts[every]) | (np.abs(begins[other] - begins[every]) >= SPAN)
        got = np.where(good, other, got)
    return got


def _of_contents(made: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows in order, and the runs of those with one key and content."""
    made = made[np.lexsort((made["l"], made["u"], made["content"], made["key"]))]
    new = np.r_[True, (made["key"][1:] != made["key"][:-1]) | (made["content"][1:] != made["content"][:-1])]
    starts = np.flatnonzero(new)
    return made, starts, np.diff(np.append(starts, len(made)))


_PAIR = ["a", "b", "begin_a", "end_a", "begin_b", "end_b"]


def _runs(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """Spans of passages that begin at x of text a and at y of text b: those next to each other make one."""
    order = np.lexsort((y, y - x, a, b))
    a, b, x, y = a[order], b[order], x[order], y[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (x[1:] != x[:-1] + 1) | (y[1:] != y[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(a))[: len(at)] - 1
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (a[at], b[at], x[at], x[last] + SPAN, y[at], y[last] + SPAN)], _PAIR)


def _parts(keys: np.ndarray) -> np.ndarray:
    """For windows in the order of their keys, how many parts those of one key are dealt into."""
    first = np.flatnonzero(np.r_[len(keys) > 0, keys[1:] != keys[:-1]])
    sizes = np.diff(np.append(first, len(keys)))
    return np.repeat(-(-sizes // PART_WINDOWS), sizes).astype(np.int32)


def _repeats(texts: DataFrame, chars: int) -> tuple[DataFrame, DataFrame]:
    """Spans of equal passages, each with one it repeats, and the windows of the first function that are not equal.

    Equal passages lie in windows of one key at one distance from c. Equal windows are
    repeats as a whole; of unequal ones with one key, passages are told by their hashes.
    """
    schema = T.StructType([*_long("key", "a", "b", "begin_a", "end_a", "begin_b", "end_b"), *[T.StructField(n, T.IntegerType()) for n in ("parts", "at")]])

    def equal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of equal windows; without a, the first and last one of each content to look into."""
        for made in _bins(batches):
            made, starts, counts = _of_contents(made)
            other = partners(starts, counts, made["u"], made["l"])
            some = np.flatnonzero(other >= 0)
            keys = made["key"][starts]
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            kinds = np.diff(np.append(first, len(keys)))
            # equal windows, all of them repeats of others, need no look into
            begins = starts[first]
            alone = np.logical_or.reduceat(other < 0, begins) & (np.diff(np.append(begins, len(made))) > 1)
            many = np.repeat((kinds > 1) | alone, kinds)
            kept = np.unique(np.concatenate([starts[many], (starts + counts - 1)[many]]))
            x, y = made[other[some]], made[some]
            linked = [y["key"], x["u"], y["u"], x["l"], x["r"] + 1, y["l"], y["r"] + 1, None, None]
            z = made[kept]
            inner = [z["key"], None, z["u"], None, None, z["l"], z["r"] + 1, _parts(z["key"]), z["c"] - z["l"]]
            kinds_of = [pa.int64()] * 7 + [pa.int32()] * 2
            for columns, size in ((linked, len(some)), (inner, len(kept))):
                yield pa.RecordBatch.from_arrays([pa.nulls(size, k) if c is None else pa.array(c.astype(k.to_pandas_dtype())) for c, k in zip(columns, kinds_of)], schema.names)

    found = stored(_dealt(texts, None, range(1), chars).mapInArrow(equal, schema), "repeats")
    inner = found.where("a is null").groupBy(F.col("b").alias("u")).agg(F.collect_list(F.struct("key", "begin_b", "end_b")).alias("windows"))
    cut_schema = T.StructType([*_long("key", "u", "begin"), T.StructField("runs", T.ArrayType(T.LongType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            places = column.offsets.to_numpy()
            keys, begins, ends = (x.to_numpy() for x in column.values.flatten())
            for row, end, data, offsets in text_blocks(batch.column(2)):
                grams, firsts, _ = shingles_of(data, offsets)
                runs, some = run_hashes(grams), slice(places[row], places[end])
                owner = np.repeat(np.arange(row, end), np.diff(places[row : end + 1]))
                counts = ends[some] - begins[some] - SPAN + 1
                taken = runs[ragged(firsts[owner - row] + begins[some], counts)].view(np.int64)
                values = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(taken))
                yield pa.RecordBatch.from_arrays([pa.array(keys[some]), batch.column(0).take(pa.array(owner)), pa.array(begins[some]), values], cut_schema.names)

    runs = inner.join(texts.select("u", "text"), "u").select("u", "windows", "text").mapInArrow(cut, cut_schema)

    def link(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        runs, texts, begins = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((begins, texts, runs))
        runs, texts, begins = runs[order], texts[order], begins[order]
        starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
        other = partners(starts, np.diff(np.append(starts, len(runs))), texts, begins)
        some = np.flatnonzero(other >= 0)
        return _runs(texts[other[some]], texts[some], begins[other[some]], begins[some])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size, group = 0, None
        for batch in batches:
            keys, texts, begins = (batch.column(k).to_numpy() for k in range(3))
            lists = batch.column(3)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            cuts = np.append(np.flatnonzero(np.r_[len(keys) > 0, keys[1:] != keys[:-1]]), len(keys)).tolist()
            for x, y in zip(cuts, cuts[1:]):
                if keys[x] != group and size > HELD_WINDOWS:
                    yield link(held)
                    held, size = [], 0
                group = keys[x]
                counts = np.diff(offsets[x : y + 1])
                held.append((values[offsets[x] : offsets[y]].copy(), np.repeat(texts[x:y], counts), ragged(begins[x:y], counts)))
                size += int(counts.sum())
        if held:
            yield link(held)

    same = runs.repartition("key").sortWithinPartitions("key").mapInArrow(within, T.StructType(_long(*_PAIR)))
    left = found.where("a is null").select("key", F.col("b").alias("u"), "parts", F.col("begin_b").cast("int").alias("low"), "at", (F.col("end_b") - F.col("begin_b")).cast("int").alias("counts"))
    return found.where("a is not null").select(*_PAIR).unionByName(stored(same, "repeats")), left


#: Of a window: how many parts the windows of its value are dealt into, the first passage, the value's place and the shingles.
_PLACE = ["parts", "low", "at", "counts"]


def _unsettled(texts: DataFrame, known: DataFrame, functions: range, chars: int) -> DataFrame:
    """Windows whose value occurs again and that what is known does not settle; of equal ones, the first and last."""
    schema = T.StructType(_long("key", "u") + [T.StructField(n, T.IntegerType()) for n in _PLACE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in _bins(batches):
            made, starts, counts = _of_contents(made)
            first = np.flatnonzero(np.r_[True, made["key"][1:] != made["key"][:-1]])
            sizes = np.diff(np.append(first, len(made)))
            left = sizes > 1
            left &= (np.minimum.reduceat(made["root"], first) != np.maximum.reduceat(made["root"], first)) | ~np.logical_and.reduceat(made["found"], first)
            kept = np.zeros(len(made), bool)
            kept[starts] = kept[starts + counts - 1] = True
            some = made[kept & np.repeat(left, sizes)]
            columns = [some["key"], some["u"], _parts(some["key"]), some["l"], some["c"] - some["l"], some["r"] - some["l"] + 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema.names)

    return _dealt(texts, known, functions, chars).mapInArrow(run, schema)


def grown(a: np.ndarray, b: np.ndarray, begin_a: int, end_a: int, begin_b: int) -> tuple[int, int]:
    """Begin and end in a of a span of shingles that a and b share, while they are equal on both sides."""
    end_b = begin_b + end_a - begin_a
    back = min(begin_a, begin_b)
    unequal = np.flatnonzero(a[begin_a - back : begin_a] != b[begin_b - back : begin_b])
    back -= int(unequal[-1]) + 1 if len(unequal) else 0
    ahead = min(len(a) - end_a, len(b) - end_b)
    unequal = np.flatnonzero(a[end_a : end_a + ahead] != b[end_b : end_b + ahead])
    return begin_a - back, end_a + (int(unequal[0]) if len(unequal) else ahead)


def _grown(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Spans of similar passages, grown as long as the words agree."""
    schema = T.StructType(_long(*_PAIR))
    fields = ["begin_a", "end_a", "begin_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [batch.column(k).to_pylist() for k in (0, 1)]
            places = batch.column(2).offsets.to_pylist()
            spans = list(zip(*(x.to_pylist() for x in batch.column(2).values.slice(0, places[-1]).flatten())))
            rows: list[tuple[int, ...]] = []
            for at in range(0, len(batch), 64):
                sides = []
                for k in (3, 4):
                    texts_of = []
                    for _, _, data, offsets in text_blocks(batch.column(k).slice(at, 64)):
                        grams, firsts, _ = shingles_of(data, offsets)
                        texts_of += [grams[x:y] for x, y in zip(firsts.tolist(), [*firsts.tolist()[1:]])]
                    sides.append(texts_of)
                for n, a, b in zip(range(at, at + 64), *sides):
                    for x, y, z in spans[places[n] : places[n + 1]]:
                        begin, end = grown(a, b, x, y, z)
                        rows.append((names[0][n], names[1][n], begin, end, begin + z - x, end + z - x))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema.names)

    lists = pairs.groupBy("a", "b").agg(F.collect_set(F.struct(*fields)).alias("spans"))
    one = lists.join(texts.select(F.col("u").alias("b"), F.col("text").alias("tb")), "b")
    both = one.join(texts.select(F.col("u").alias("a"), F.col("text").alias("ta")), "a")
    return both.select("a", "b", "spans", "ta", "tb").mapInArrow(run, schema)


def _sides(sides: DataFrame) -> DataFrame:
    """Spans found in each text; those whose passages are next to each other are one."""
    schema = T.StructType(_long("u") + [T.StructField("spans", T.ArrayType(T.StructType(_long("begin", "end"))))])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(1).offsets.to_numpy()
            begins, ends = (x.to_numpy() for x in batch.column(1).values.slice(places[0], places[-1] - places[0]).flatten())
            row = np.repeat(np.arange(len(batch)), np.diff(places))
            order = np.lexsort((begins, row))
            row, begins, ends = row[order], begins[order], ends[order]
            # the greatest end so far in a text, whose places come after those of the text before
            step = int(ends.max(initial=0)) + SPAN
            reach = np.maximum.accumulate(row * step + ends)
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (begins[1:] > reach[:-1] - row[1:] * step - (SPAN - 1))
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(row))[: len(at)] - 1
            merged = pa.StructArray.from_arrays([pa.array(begins[at]), pa.array(reach[last] - row[last] * step)], ["begin", "end"])
            offsets = np.searchsorted(row[at], np.arange(len(batch) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), merged)], schema.names)

    once = sides.groupBy("u", "begin").agg(F.max("end").alias("end"))
    return once.groupBy("u").agg(F.collect_list(F.struct("begin", "end")).alias("spans")).mapInArrow(merge, schema)


def _known(known: DataFrame | None, pairs: DataFrame) -> DataFrame:
    """Spans found in each text, and the least text of its component if it has others, by what was known and more pairs."""
    sides = pairs.select(F.col("a").alias("u"), F.col("begin_a").alias("begin"), F.col("end_a").alias("end")).unionByName(
        pairs.select(F.col("b").alias("u"), F.col("begin_b").alias("begin"), F.col("end_b").alias("end"))
    )
    links = pairs.select("a", "b")
    if known is not None:
        sides = sides.unionByName(known.select("u", F.inline("spans")))
        links = links.unionByName(known.where("root != u").select(F.col("u").alias("a"), F.col("root").alias("b")))
    roots = components(links.distinct()).select(F.col("node").alias("u"), "root")
    return _sides(sides).join(roots, "u", "left")


def _first_places(grams: np.ndarray) -> np.ndarray:
    """For each passage begin, the places of its distinct shingles."""
    order = np.argsort(grams, kind="stable")
    before = np.full(len(grams), -1)
    same = grams[order[1:]] == grams[order[:-1]]
    before[order[1:][same]] = order[:-1][same]
    begins, places = np.arange(len(grams) - SPAN + 1)[:, None], np.arange(len(grams))
    return (places >= begins) & (places < begins + SPAN) & (before < begins)


def alike(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> np.ndarray:
    """Which passage begins of both windows' shingles are similar enough."""
    sums = np.zeros((len(a), len(b) + 1), np.int32)
    np.cumsum(a[:, None] == b, axis=1, out=sums[:, 1:])
    less = of_a.astype(np.float32) @ (sums[:, SPAN:] > sums[:, :-SPAN]).astype(np.float32)
    more = of_a.sum(axis=1)[:, None] + of_b.sum(axis=1) - less
    return less * SIMILAR[1] >= more * SIMILAR[0]


def _within_reach(common: np.ndarray, sizes: np.ndarray, least: int) -> np.ndarray:
    """Passages with enough of their shingles in common for one similar to be of ``least`` shingles or more."""
    # similar passages have four ninths of both ones' shingles in common, and four fifths of each one's
    return (common * sum(SIMILAR) >= (sizes + least) * SIMILAR[0]) & (common * SIMILAR[1] >= np.maximum(sizes, least) * SIMILAR[0])


def _before(table: np.ndarray) -> np.ndarray:
    """For each place of the windows' shingles, the last one before of the same shingle, or -1."""
    order = np.argsort(table, axis=1, kind="stable")
    kinds = np.take_along_axis(table, order, axis=1)
    before = np.full(table.shape, -1)
    np.put_along_axis(before, order[:, 1:], np.where(kinds[:, 1:] == kinds[:, :-1], order[:, :-1], -1), axis=1)
    return before


def _distinct(hits: np.ndarray, since: np.ndarray) -> np.ndarray:
    """Different shingles, of those hit, in each passage of the windows."""
    count, wide = len(hits), hits.shape[1] + 1
    row, place = np.nonzero(hits)
    steps = np.bincount(row * wide + since[row, place], minlength=count * wide) - np.bincount(row * wide + place + 1, minlength=count * wide)
    return np.cumsum(steps.reshape(count, wide), axis=1)[:, :SPAN]


def _sums(hits: np.ndarray) -> np.ndarray:
    """Places hit in each passage of the windows."""
    sums = np.zeros((len(hits), hits.shape[1] + 1), np.int16)
    np.cumsum(hits, axis=1, out=sums[:, 1:])
    return sums[:, SPAN:] - sums[:, :-SPAN]


def _viable(table: np.ndarray, new: np.ndarray, since: np.ndarray, sizes: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """Passages of whose shingles enough are in other windows at all, and which of the kinds are in several of these.

    ``new`` tells where a window has a shingle for the first time.
    """
    alive = np.arange(len(table))
    viable, often = np.zeros(sizes.shape, bool), np.zeros(kinds + 1, bool)
    once = (new | (table == kinds)).all(axis=1)
    while len(alive) > 1:
        some = table[alive]
        often = np.bincount(some[new[alive]], minlength=kinds + 1) > 1
        often[-1] = False
        hits = often[some]
        common = _sums(hits)
        if len(twice := np.flatnonzero(~once[alive])):
            common[twice] = _distinct(hits[twice], since[alive[twice]])
        some = _within_reach(common, sizes[alive], int(sizes[alive].min()))
        left = some.any(axis=1)
        if left.all():
            viable[alive] = some
            break
        alive = alive[left]
    return viable, often


class _Meeting:
    """Windows of some values, in the order of their ``group``, and the passages that are yet to be found or joined.

    All windows lie with their value in the column ``SPAN - 1``, so that passages of one alignment
    begin in one column. ``at`` is the value's place in a window, ``grams`` has the shingles of all
    windows, none of them in two groups, and ``known`` tells of each passage that it is known.
    Windows of a group that goes ``across`` meet those of other parts only. Passages that have
    the value of a function before ``function``, that of a group's windows, in common met by that one.
    """

    def __init__(self, group: np.ndarray, text: np.ndarray, root: np.ndarray, part: np.ndarray, low: np.ndarray, at: np.ndarray, counts: np.ndarray, grams: np.ndarray, known: np.ndarray, across: np.ndarray, function: np.ndarray | None = None, salt: np.ndarray | None = None):
        width = 2 * SPAN - 1
        found = pa.array(grams).dictionary_encode()
        names, codes = found.dictionary.to_numpy(), found.indices.to_numpy()
        self.none, shift = len(names), SPAN - 1 - at
        columns = np.arange(width)
        self.table = np.full((len(group), width), self.none, np.int32)
        inside = (columns >= shift[:, None]) & (columns < (shift + counts)[:, None])
        self.table[inside] = codes
        self.function = np.zeros(len(group), np.int64) if function is None else function
        self.names, self.salt = np.append(names, _U64(0)), np.zeros(len(group), _U64) if salt is None else salt
        # which of so many remainders a window's codes have
        self.rests = np.zeros((len(group), RESTS), bool)
        self.rests[np.arange(len(group))[:, None], self.table % RESTS] = True
        self.every = (columns[:SPAN] >= shift[:, None]) & (columns[:SPAN] <= (shift + counts - SPAN)[:, None])
        ordered = np.sort(self.table, axis=1)
        twice = np.flatnonzero(((ordered[:, 1:] == ordered[:, :-1]) & (ordered[:, 1:] < self.none)).any(axis=1))
        # for each place, the first passage in which its shingle is the first of its kind
        self.since = np.broadcast_to(np.maximum(columns - SPAN + 1, 0).astype(np.int16), inside.shape).copy()
        before = _before(self.table[twice])
        self.since[twice] = np.maximum(self.since[twice], before + 1)
        new = inside.copy()
        new[twice] &= before < 0
        self.sizes = np.where(self.every, SPAN, 2 * width)
        self.sizes[twice] = np.where(self.every[twice], _distinct(inside[twice], self.since[twice]), 2 * width)
        self.viable, self.often = _viable(self.table, new, self.since, self.sizes, self.none)
        self.open = np.zeros(self.every.shape, bool)
        self.open[self.every] = ~known
        self.open &= self.viable
        self.group, self.text, self.part, self.across, self.counts, self.shift = group, text, part, across, counts, shift
        self.own = np.unique(root, return_inverse=True)[1]
        self.least, self.low = self.sizes.min(axis=1), low - shift
        self.first, self.last = low, low + counts - SPAN
        self.plain = (~self.every | (self.sizes == SPAN)).all(axis=1)
        self.alive = np.flatnonzero(self.viable.any(axis=1))
        self.kept: list[np.ndarray] = []

    def settle(self, m: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
        """Of similar passages, keep the first of each one that is open, and one for texts not yet joined."""
        turn = m > n
        m, n, i, j = np.where(turn, n, m), np.where(turn, m, n), np.where(turn, j, i), np.where(turn, i, j)
        new = np.zeros(len(m), bool)
        for window, begin in ((m, i), (n, j)):
            place, first = np.unique(window * SPAN + begin, return_index=True)
            new[first] |= self.open.ravel()[place]
        apart = np.flatnonzero(self.own[m] != self.own[n])
        if len(apart):
            _, first = np.unique(self.own[m[apart]] * len(self.own) + self.own[n[apart]], return_index=True)
            for p in apart[np.sort(first)].tolist():
                x, y = self.own[m[p]], self.own[n[p]]
                if x != y:
                    self.own[self.own == x] = y
                    new[p] = True
        self.open[m, i] = self.open[n, j] = False
        self.kept.append(np.stack([m[new], n[new], i[new], j[new]]))

    def by_hashes(self) -> None:
        """Passages that are alike but for shingles of their own alone, by hashes of the others."""
        some = self.alive[self.plain[self.alive]]
        shared = self.often[self.table[some]]
        codes = mix(np.where(shared, self.table[some] + 1, 0).astype(_U64).ravel()).reshape(shared.shape)
        hashes = run_hashes(codes.T).T
        enough = self.viable[some] & (_sums(shared) * sum(SIMILAR) >= 2 * SPAN * SIMILAR[0])
        row, begin = np.nonzero(enough)
        window, value = some[row], hashes[row, begin]
        order = np.lexsort((self.low[window] + begin, self.text[window], value))
        window, begin, value = window[order], begin[order], value[order]
        starts = np.flatnonzero(np.r_[len(value) > 0, value[1:] != value[:-1]])
        other = partners(starts, np.diff(np.append(starts, len(value))), self.text[window], self.low[window] + begin)
        mine = np.flatnonzero(other >= 0)
        theirs = other[mine]
        mine, theirs = (x[self.may_meet(window[mine], window[theirs])] for x in (mine, theirs))
        order = np.lexsort((begin[mine], window[theirs], window[mine]))
        mine, theirs = mine[order], theirs[order]
        self.settle(window[theirs], window[mine], begin[theirs], begin[mine])

    def may_meet(self, m: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Not if all their passages overlap in one text."""
        far = np.maximum(self.last[m] - self.first[n], self.last[n] - self.first[m]) >= SPAN
        return (far | (self.text[m] != self.text[n])) & (~self.across[m] | (self.part[m] != self.part[n]))

    def needed(self, m: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.open[m].any(axis=1) | self.open[n].any(axis=1) | (self.own[m] != self.own[n])

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows of one value with enough shingles in common for similar passages, and how many these are."""
        groups = self.group[self.alive]
        cuts = np.append(np.flatnonzero(np.r_[len(groups) > 0, groups[1:] != groups[:-1]]), len(groups)).tolist()
        # a group is done if nothing in it is open and it is of one component
        own, done = self.own[self.alive], []
        if len(groups):
            starts = cuts[:-1]
            apart = np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts)
            done = (~apart & ~np.logical_or.reduceat(self.open[self.alive].any(axis=1), starts)).tolist()
        some: list[np.ndarray] = []
        size = 0
        for x, y, over in zip(cuts, cuts[1:], done):
            if y - x < 2 or over:
                continue
            if y - x > 4 * DENSE_WINDOWS:
                yield from self.pairs_of_many(self.alive[x:y])
                continue
            if some and size + y - x > DENSE_WINDOWS:
                yield self.pairs_of_few(np.concatenate(some))
                some, size = [], 0
            some.append(self.alive[x:y])
            size += y - x
        if some:
            yield self.pairs_of_few(np.concatenate(some))

    def pairs_of_few(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By one product of matrices."""
        codes = self.table[some]
        codes = np.where(self.often[codes], codes, -1)
        kinds, place = np.unique(codes, return_inverse=True)
        holds = np.zeros((len(some), len(kinds)), np.float32)
        holds[np.arange(len(some))[:, None], place.reshape(codes.shape)] = kinds[place.reshape(codes.shape)] >= 0
        common = holds @ holds.T
        least = self.least[some]
        good = np.triu(common * sum(SIMILAR) >= (least[:, None] + least) * SIMILAR[0], 1)
        good &= self.group[some][:, None] == self.group[some]
        i, j = np.nonzero(good)
        return some[i], some[j], common[i, j]

    def pairs_of_many(self, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Window after window, by the windows of each shingle."""
        row, place = np.nonzero(self.often[self.table[some]])
        kinds = np.unique(self.table[some[row], place].astype(np.int64) * len(some) + row)
        holders, values = kinds % len(some), kinds // len(some)
        every = np.arange(len(some))
        for n, window in enumerate(some.tolist()):
            if not n % 32:
                still = self.open[some].any(axis=1)
            if still[n]:
                near = (every > n) | ~still
                near[n] = False
            else:
                near = (every < n) & (self.own[some] != self.own[window])
            near = np.flatnonzero(near)
            near = near[self.may_meet(np.full(len(near), window), some[near])]
            if not len(near):
                continue
            mine = np.unique(self.table[window])
            begins, ends = np.searchsorted(values, mine), np.searchsorted(values, mine, "right")
            common = np.bincount(holders[ragged(begins, ends - begins)], minlength=len(some))[near]
            enough = common * sum(SIMILAR) >= (self.least[some[near]] + self.least[window]) * SIMILAR[0]
            near = near[enough]
            yield np.full(len(near), window), some[near], common[enough]

    def meet(self) -> None:
        """Compare windows of one value two by two, till all passages are known and all texts joined."""
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for pairs in self.pairs():
            held.append(pairs)
            size += len(pairs[0])
            if size > HELD_PAIRS:
                self.compare(*(np.concatenate(x) for x in zip(*held)))
                held, size = [], 0
        if held:
            self.compare(*(np.concatenate(x) for x in zip(*held)))

    def compare(self, m: np.ndarray, n: np.ndarray, common: np.ndarray) -> None:
        """Pairs of windows, those with most in common first: in the value's alignment, then in all."""
        some = self.may_meet(m, n)
        m, n, common = m[some], n[some], common[some]
        order = np.argsort(-common, kind="stable")
        m, n = m[order], n[order]
        for look, most in ((self.aligned, 4096), (self.in_all, 512)):
            at = 0
            while at < len(m):
                x, y = m[at : at + most], n[at : at + most]
                at += most
                some = self.needed(x, y)
                if some.any():
                    look(x[some], y[some])

    def not_met(self, m: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether passages that are open, or any of texts not joined yet, met not all passages of the other window before."""
        before = int(self.function[m].max(initial=0))
        if not before:
            return np.ones(len(m), bool)
        met = ~(self.every[m][:, :, None] & self.every[n][:, None, :])
        sides = [np.where((codes := self.table[x]) < self.none, self.names[codes] ^ self.salt[x][:, None], 0) for x in (m, n)]
        for k in range(before):
            a, b = (least_of_spans(np.where(self.table[x] < self.none, min_hashes(side, k), _U64(2**64 - 1)).T).T for x, side in zip((m, n), sides))
            met |= (a[:, :, None] == b[:, None, :]) & (self.function[m] > k)[:, None, None]
        apart = (self.own[m] != self.own[n])[:, None]
        return ((self.open[m] | apart) & ~met.all(axis=2)).any(axis=1) | ((self.open[n] | apart) & ~met.all(axis=1)).any(axis=1)

    def aligned(self, m: np.ndarray, n: np.ndarray) -> None:
        """Passages that are similar in the value's alignment, which begin in one column or a few apart."""
        some = self.plain[m] & self.plain[n] & ((self.text[m] != self.text[n]) | (np.abs(self.low[m] - self.low[n]) >= 2 * SPAN))
        m, n = m[some], n[some]
        equal = (self.table[m] == self.table[n]) & (self.table[m] < self.none)
        sums = np.zeros((len(m), equal.shape[1] + 1), np.int16)
        np.cumsum(equal, axis=1, out=sums[:, 1:])
        least = -(-2 * SPAN * SIMILAR[0] // sum(SIMILAR))
        for d in range(SPAN - least + 1):
            for x, y in ((m, n), (n, m))[: 1 + (d > 0)]:
                good = sums[:, SPAN : 2 * SPAN - d] - sums[:, d:SPAN] >= least
                good &= self.every[x, : SPAN - d] & self.every[y, d:]
                good &= self.open[x, : SPAN - d] | self.open[y, d:] | (self.own[x] != self.own[y])[:, None]
                pair, begin = np.nonzero(good)
                if len(pair):
                    self.settle(x[pair], y[pair], begin, begin + d)

    def reaching(self, x: np.ndarray, y: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Whether passages of windows ``x`` hit enough, at most, of the shingles of ``y``."""
        return self.viable[x] & (_sums(hits) * sum(SIMILAR) >= (self.sizes[x] + self.least[y][:, None]) * SIMILAR[0])

    def in_all(self, m: np.ndarray, n: np.ndarray) -> None:
        """Passages that are similar in any alignment: first those with enough shingles in the other window."""
        apart = self.own[m] != self.own[n]
        # by remainders, which may hit too much but never too little
        near = []
        for x, y in ((m, n), (n, m)):
            a = self.table[x]
            near.append(self.reaching(x, y, self.rests[y[:, None], a % RESTS] & (a < self.none)))
        some = (near[0] & self.open[m]).any(axis=1) | (near[1] & self.open[n]).any(axis=1) | (apart & near[0].any(axis=1) & near[1].any(axis=1))
        m, n = m[some], n[some]
        some = self.not_met(m, n)
        m, n = m[some], n[some]
        apart = self.own[m] != self.own[n]
        near = []
        for x, y in ((m, n), (n, m)):
            some = np.flatnonzero(apart | self.open[x].any(axis=1))
            a = self.table[x[some]]
            hits = (a[:, :, None] == self.table[y[some]][:, None, :]).any(axis=2) & (a < self.none)
            both = _distinct(hits, self.since[x[some]])
            enough = np.zeros((len(x), SPAN), bool)
            enough[some] = self.viable[x[some]] & (both * sum(SIMILAR) >= (self.sizes[x[some]] + self.least[y[some]][:, None]) * SIMILAR[0])
            near.append(enough)
        wanted = (near[0] & self.open[m]).any(axis=1) | (near[1] & self.open[n]).any(axis=1) | (apart & near[0].any(axis=1) & near[1].any(axis=1))
        for p in np.flatnonzero(wanted).tolist():
            self.whole(int(m[p]), int(n[p]), near[0][p], near[1][p])

    def whole(self, m: int, n: int, near_m: np.ndarray, near_n: np.ndarray) -> None:
        if not ((near_m & self.open[m]).any() or (near_n & self.open[n]).any() or self.own[m] != self.own[n]):
            return
        a, b = (self.table[w, self.shift[w] : self.shift[w] + self.counts[w]] for w in (m, n))
        ok = alike(a, b, _first_places(a), _first_places(b))
        i, k = np.nonzero(ok)
        i, k = i + self.shift[m], k + self.shift[n]
        if self.text[m] == self.text[n]:
            some = np.abs(self.low[m] + i - self.low[n] - k) >= SPAN
            i, k = i[some], k[some]
        if not len(i):
            return
        # the commonest shift first, so that passages fall on few diagonals
        shifts, place, counts = np.unique(k - i, return_inverse=True, return_counts=True)
        order = np.argsort(-counts[place], kind="stable")
        self.settle(np.full(len(i), m), np.full(len(i), n), i[order], k[order])

    def points(self) -> np.ndarray:
        """Windows and, in their texts, begins of the passages kept: a row for m, n, i and j."""
        if len(self.alive) < 2:
            return np.zeros((4, 0), np.int64)
        self.by_hashes()
        self.meet()
        m, n, i, j = np.concatenate(self.kept, axis=1)
        return np.stack([m, n, self.low[m] + i, self.low[n] + j])


def compared(
    texts: list[int], lows: list[int], roots: list[int], found: list, parts: list[int], grams: list[np.ndarray], across: bool, sizes_of: list[int] | None = None
) -> list[tuple[int, int, list[int]]]:
    """Pairs of one value's windows, and begins of passages, that join texts or are new.

    ``found`` tells of each window or of each of its passages that it is known, ``across``
    that only windows of different parts are to meet. There may be several values, with no
    shingle in common, of ``sizes_of`` windows each.
    """
    count, counts = len(grams), np.array([len(g) for g in grams])
    known = np.concatenate([np.broadcast_to(f, max(c - SPAN + 1, 0)) for f, c in zip(found, counts.tolist())])
    group = np.repeat(np.arange(len(sizes_of or [count])), sizes_of or [count])
    meeting = _Meeting(group, np.array(texts), np.array(roots), np.array(parts), np.array(lows), np.full(count, SPAN - 1), counts, np.concatenate(grams), known, np.full(count, across))
    m, n, i, j = meeting.points()
    pairs: dict[tuple[int, int], list[int]] = {}
    for a, b, x, y in zip(m.tolist(), n.tolist(), i.tolist(), j.tolist()):
        pairs.setdefault((a, b), []).extend((x, y))
    return [(a, b, points) for (a, b), points in pairs.items()]


_PLACED = ["key", "x", "y", "part", "u", "root", "low", "at"]


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one value and two parts are in one batch, of ``MEET_WINDOWS`` rows or more but for the last."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, len(batch), MEET_WINDOWS):
            held.append(batch.slice(at, MEET_WINDOWS))
            size += len(held[-1])
            if size < MEET_WINDOWS:
                continue
            whole = pa.concat_batches(held)
            names = [whole.column(k).to_numpy() for k in range(3)]
            cuts = np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], axis=0)) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            if last:
                yield whole.slice(0, last)
            held, size = [whole.slice(last)], 0 if last else size
    if held:
        yield pa.concat_batches(held)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the lists, and all their values in a row."""
    offsets = column.offsets.to_numpy()
    return np.diff(offsets), column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)


def _compared(windows: DataFrame, texts: DataFrame, known: DataFrame) -> DataFrame:
    """Spans of similar passages in the windows of one value, each two of which meet."""
    fields = ["key", *_PLACE]
    lists = windows.groupBy("u").agg(F.collect_list(F.struct(*fields)).alias("windows"))
    lists = _named(texts, known).join(lists.hint("shuffle_hash"), "u")
    of_lists = [T.StructField("found", T.ArrayType(T.BooleanType())), T.StructField("grams", T.ArrayType(T.LongType()))]
    whole = T.StructType([*_long("key", "u", "root"), *[T.StructField(n, T.IntegerType()) for n in ("parts", "low", "at")], *of_lists])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            places = column.offsets.to_numpy()
            for row, end, data, offsets in text_blocks(batch.column(2)):
                grams, firsts, _ = shingles_of(data, offsets)
                known = _known_begins(batch.column(3), row, end, firsts, len(grams))
                held = dict(zip(fields, column.values.slice(places[row], places[end] - places[row]).flatten()))
                owner = np.repeat(np.arange(row, end), np.diff(places[row : end + 1]))
                low, counts = held["low"].to_numpy(), held["counts"].to_numpy()
                for at in range(0, len(owner), 4096):
                    s = slice(at, at + 4096)
                    values = []
                    for array, many in ((known, counts[s] - SPAN + 1), (grams.view(np.int64), counts[s])):
                        taken = array[ragged(firsts[owner[s] - row] + low[s], many)]
                        values.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)), pa.int32()), pa.array(taken)))
                    kept = {n: held[n].slice(at, 4096) for n in fields} | {n: batch.column(k).take(pa.array(owner[s])) for n, k in (("u", 0), ("root", 4))}
                    yield pa.RecordBatch.from_arrays([*(kept[n] for n in whole.names[:-2]), *values], whole.names)

    own = lists.select("u", "windows", "text", "spans", "root").mapInArrow(cut, whole)
    placed = own.withColumn("part", F.pmod(F.xxhash64("u", "low"), F.col("parts")).cast("int"))
    met = placed.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    met = met.withColumns({"x": F.least("part", "other"), "y": F.greatest("part", "other")}).select(*_PLACED, "found", "grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches):
            key, x, y, part, u, root, low, at = (batch.column(k).to_numpy() for k in range(len(_PLACED)))
            group = np.cumsum(np.r_[False, (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            (_, found), (counts, grams) = (_lists(batch.column(len(_PLACED) + k)) for k in (0, 1))
            # shingles of different groups are told apart
            salt = mix(mix(key.view(_U64)) ^ (x.astype(_U64) << _U64(32) | y.astype(_U64)))
            m, n, i, j = _Meeting(group, u, root, part, low.astype(np.int64), at.astype(np.int64), counts.astype(np.int64), grams.view(_U64) ^ np.repeat(salt, counts), found, x != y, key & _FUNCTION, salt).points()
            yield _runs(u[m], u[n], i, j)

    return met.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(run, T.StructType(_long(*_PAIR)))


def _passages(texts: DataFrame) -> DataFrame:
    """What is known of texts when all windows of one value have met: equal passages first, then similar ones."""
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    pairs, windows = _repeats(texts, chars)
    known = stored(_known(None, pairs), "known")
    rounds: list[DataFrame] = []
    # what one function finds, the others need not compare; few at a time hold fewer windows on disk
    for functions in (range(1), range(1, 3), range(3, HASHES)):
        if rounds:
            known = stored(_known(known, rounds[-1]), "known")
            windows = stored(_unsettled(texts, known, functions, chars), "windows")
        rounds.append(stored(_compared(windows, texts, known), "passages"))
    pairs = stored(_grown(functools.reduce(DataFrame.unionByName, rounds), texts), "passages")
    return stored(_known(known, pairs), "known")


def find(docs: DataFrame, text: str = "text", key: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """Documents with ``n_words``, ``n_repeated_words``, ``spans`` (of words) and ``class_id``."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    named = docs.withColumn("__u", F.xxhash64(whole))
    texts = stored(named.groupBy(F.col("__u").alias("u")).agg(F.first(whole).alias("text"), F.count(F.lit(1)).alias("copies"), F.min(F.col(f"`{key}`")).alias("least")), "texts")
    known = _passages(texts).withColumnRenamed("spans", "__spans")
    placed = texts.select("u", "copies", "least").join(known, "u", "left").withColumn("root", F.coalesce("root", "u"))
    classes = placed.groupBy("root").agg(F.min("least").alias("__class"))
    found = placed.join(classes, "root").select("u", "copies", "__class", "__spans")
    own = T.StructType(
        _long("n_words", "n_repeated_words")
        + [T.StructField("spans", T.ArrayType(T.StructType(_long("begin", "end")))), T.StructField("class_id", docs.schema[key].dataType)]
    )
    kept = [c for c in docs.columns if c not in own.names and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in kept] + own.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            copies, lists = batch.column(len(kept) + 1).to_pylist(), batch.column(len(kept) + 2)
            for row, end, data, offsets in text_blocks(batch.column(len(kept))):
                _, _, words = shingles_of(data, offsets)
                cuts, totals = [], []
                for n, count in enumerate(words.tolist(), row):
                    parts = lists[n].as_py() or []
                    if copies[n] > 1 and count >= PASSAGE:
                        parts = [{"begin": 0, "end": count - SHINGLE + 1}]
                    begins = np.array([p["begin"] for p in parts], np.int64)
                    flags = covered(begins, np.array([p["end"] + SHINGLE - 1 for p in parts], np.int64), count)
                    steps = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
                    cuts.append([{"begin": x, "end": y} for x, y in zip(np.flatnonzero(steps == 1).tolist(), np.flatnonzero(steps == -1).tolist())])
                    totals.append(int(flags.sum()))
                old = [batch.column(k).slice(row, end - row) for k in range(len(kept))]
                new = [pa.array(words), pa.array(totals, pa.int64()), pa.array(cuts, kind), batch.column(len(kept) + 3).slice(row, end - row)]
                yield pa.RecordBatch.from_arrays(old + new, schema.names)

    joined = named.join(found.withColumnRenamed("u", "__u"), "__u")
    return joined.select(*[F.col(f"`{c}`") for c in kept], whole.alias("__text"), "copies", "__spans", "__class").mapInArrow(run, schema)
