"""Removal of long byte strings that occur again, by a run-length index.

Every ``length``-byte string of a text is handed to one bucket: that of the string's least
``anchor``-byte hash, so equal strings meet in one bucket whichever texts hold them. Strings
of one text that follow each other and share that anchor stay together as one piece. Only
pieces whose anchor is seen twice are cut out and shuffled.

A task indexes many buckets at once: it sorts the suffixes of the distinct pieces, takes
the bytes before them as Burrows-Wheeler transform, and keeps positions and common prefixes
only where a run of that transform begins or ends. Inside a run the text one place on
matches one byte less, so streaming over a piece from one sampled run end to the next gives
the matching statistics of all its places; equal pieces are one piece of higher weight.

A bucket with more than ``BUCKET_PIECES`` occurrences is not indexed whole: its strings are
told apart by 128-bit hashes and counted, with counts combined before the shuffle, so no
task holds it.

Defined cases: a NULL text is empty; texts under ``length`` bytes are left alone; equal
rows are each other's repeats; empty tables give empty results. ``remove_repeats`` keeps
other columns, and its own result columns replace columns of the same names. Bytes that
no longer form a character after a removal are dropped from the text, while the
digest is of all remaining bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from strata.llm.store import stored
from strata.llm.textops import every_gram_hash, prefix_hash, ragged, span_hash, text_blocks

LENGTH = 200
ANCHOR = 48
BUCKET_PIECES = 50_000
#: Bytes of distinct pieces that a task indexes at a time.
INDEX_BYTES = 1_500_000
_NEAR = 20
_TERMINATOR = 0xFF  # in no UTF-8 text

_ID = ["__u1", "__u2"]
_RESULTS = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


# ---------------------------------------------------------------- pieces


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    if len(values) < width:
        return values[:0]
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


#: A gram's rank among its neighbours: so many leading bits of its hash, then its place.
_PLACE_BITS = np.uint64(40)


def anchor_places(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """The grams' hashes, and the begin, text and anchor's place of every string."""
    hashes = every_gram_hash(prefix_hash(data), anchor)
    order = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_min(order, length - anchor + 1)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    strings = ragged(offsets[:-1], counts)
    place = (least[strings] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    return hashes, strings, np.repeat(np.arange(len(counts)), counts), place


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, text, first string (in the text), number of strings and of anchor
    places per piece. A piece with several places of its anchor may repeat itself."""
    hashes, strings, texts, place = anchor_places(data, offsets, length, anchor)
    if not len(strings):
        return np.zeros(0, np.uint64), texts, strings, strings, strings
    values = hashes[place]
    new = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])])
    moves = np.r_[0, np.cumsum(place[1:] != place[:-1])]
    last = np.append(new[1:], len(strings)) - 1
    return values[new], texts[new], strings[new] - offsets[texts[new]], last - new + 1, moves[last] - moves[new] + 1


def _identified(docs: DataFrame, text: str) -> DataFrame:
    """Texts with a 128-bit identity, the same for equal texts in any table."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.withColumns({_ID[0]: F.xxhash64(whole), _ID[1]: F.xxhash64(F.lit(1), whole)})


def _anchors(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    schema = T.StructType(_long("h", *_ID, "first", "strings", "anchors"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(k).to_numpy() for k in range(2)]
            for row, end, data, offsets in text_blocks(batch.column(2)):
                hashes, owner, first, sizes, places = pieces_of(data, offsets, length, anchor)
                columns = [hashes.view(np.int64), ids[0][row:end][owner], ids[1][row:end][owner], first, sizes, places]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema.names)

    return texts.mapInArrow(run, schema)


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted pieces."""
    schema = T.StructType(_long("h", *_ID, "first", "copies") + [T.StructField("hot", T.BooleanType()), T.StructField("piece", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                lists = part.column(3)
                owner = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
                fields = dict(zip([f.name for f in lists.type.value_type], lists.flatten().flatten()))
                texts_ = [t.encode() for t in part.column(2).to_pylist()]
                first, sizes = fields["first"].to_numpy(), fields["strings"].to_numpy()
                found = [texts_[o][a : a + n + length - 1] for o, a, n in zip(owner.tolist(), first.tolist(), sizes.tolist())]
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [fields["h"], part.column(0).take(at), part.column(1).take(at), fields["first"], part.column(4).take(at), fields["hot"], pa.array(found, pa.binary())],
                    schema.names,
                )

    return texts.select(*_ID, "text", "wanted", "copies").mapInArrow(run, schema)


# ---------------------------------------------------------------- index


def _ordered(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of keys below ``2 ** bits``, and the keys in order.

    Where a place fits beside its key, whole numbers are sorted, which is several times faster.
    """
    place_bits = int(len(keys)).bit_length()
    if bits + place_bits > 64:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    packed = np.sort((keys.astype(np.uint64) << np.uint64(place_bits)) | np.arange(len(keys), dtype=np.uint64))
    return (packed & np.uint64((1 << place_bits) - 1)).astype(np.int64), packed >> np.uint64(place_bits)


def _ranked(keys: np.ndarray, bits: int, above: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each key how many are less, and whether it occurs once; with ``above``, which
    keys must follow first, counted among those with the same ``above`` and added to it."""
    order, sorted_keys = _ordered(keys, bits)
    at = np.arange(len(keys))
    new = np.ones(len(keys) + 1, bool)
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=new[1:-1])
    steps = np.maximum.accumulate(np.where(new[:-1], at, 0))
    if above is not None:
        of = above[order]
        head = np.ones(len(of), bool)
        np.not_equal(of[1:], of[:-1], out=head[1:])
        steps += of - np.maximum.accumulate(np.where(head, at, 0))
    ranks, once = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    ranks[order], once[order] = steps, new[:-1] & new[1:]
    return ranks, once


class RunLengthIndex:
    """The run ends of the Burrows-Wheeler transform of distinct pieces.

    Only the first ``count[i]`` places of piece ``i`` are ranked; they are where a
    string of the asked-for length begins.
    """

    def __init__(self, pieces: list[bytes], length: int) -> None:
        pad = bytes([_TERMINATOR]) * 8
        self.length = length
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(pad.join(pieces) + pad * 2, np.uint8)
        self.begins = np.cumsum(self.sizes + 8) - (self.sizes + 8)
        self.counts = np.maximum(self.sizes - length + 1, 0)
        real = ragged(self.begins, self.sizes)
        ends = np.repeat(self.begins + self.sizes, self.sizes)
        self._rank_all(data, real, ends)
        self.places = ragged(self.begins, self.counts)
        self.is_first = np.zeros(len(data), bool)
        self.is_first[self.begins] = True
        ranks = self.levels[-1][1]
        # places ascend, so suffixes of one rank stay in their order
        suffixes = self.places[_ordered(ranks[self.places], int(len(data)).bit_length())[0]]
        before = np.where(self.is_first[suffixes], -1, data[suffixes - 1].astype(np.int64))
        same = (before[1:] == before[:-1]) & (before[1:] >= 0)
        heads, tails = np.flatnonzero(np.r_[True, ~same])[: len(suffixes)], np.flatnonzero(np.r_[~same, True])[: len(suffixes)]
        #: Sampled run ends: text position and common prefix with the neighbour outside.
        self.heads, self.head_prefix = suffixes[heads], self._common(data, suffixes[heads - 1], suffixes[heads])
        after = (tails + 1) % max(len(suffixes), 1)
        self.tails, self.tail_prefix = suffixes[tails], self._common(data, suffixes[after], suffixes[tails])
        if len(suffixes):
            self.head_prefix[heads == 0] = 0
            self.tail_prefix[tails == len(suffixes) - 1] = 0

    def _rank_all(self, data: np.ndarray, real: np.ndarray, ends: np.ndarray) -> None:
        """Ranks of all places by their first few bytes, and twice as many each time, ending at terminators.

        The bytes that occur are numbered, so that as many as possible are sorted at first.
        """
        occurs = np.zeros(256, bool)
        occurs[data] = True
        width = int(occurs.sum()).bit_length()
        size = min(8, max(2, (64 - len(real).bit_length()) // width))
        codes = np.cumsum(occurs)[data].astype(np.uint64)
        words = np.zeros(len(data) - 8, np.uint64)
        for k in range(size):
            words = (words << np.uint64(width)) | codes[k : k + len(words)]
        ranks, once = _ranked(words[real], size * width)
        full = np.full(len(data) + 1, len(real) + 1, np.int32)
        full[real] = ranks + 1
        self.levels: list[tuple[int, np.ndarray]] = [(size, full)]
        longest, bits = int(self.sizes.max(initial=0)), (len(real) * (len(real) + 2)).bit_length()
        tied, ranks, stop = real[~once], ranks[~once], ends[~once]
        while len(tied) and size <= longest:
            # places that are alike up to their pieces' ends stay so
            ahead = tied + size
            on = ahead <= stop
            tied, ranks, stop = tied[on], ranks[on], stop[on]
            ranks, once = _ranked(ranks * (len(real) + 2) + full[ahead[on]], bits, ranks)
            full = full.copy()
            full[tied] = ranks + 1
            size *= 2
            self.levels.append((size, full))
            tied, ranks, stop = tied[~once], ranks[~once], stop[~once]

    def _common(self, data: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Bytes that the texts from two places share, up to a terminator or so."""
        shared = np.zeros(len(left), np.int64)
        for size, ranks in reversed(self.levels):
            a, b = np.minimum(left + shared, len(data)), np.minimum(right + shared, len(data))
            shared += np.where((ranks[a] == ranks[b]) & (a < len(data)) & (b < len(data)) & (data[np.minimum(a, len(data) - 1)] != _TERMINATOR), size, 0)
        for _ in range(8):
            a, b = np.minimum(left + shared, len(data) - 1), np.minimum(right + shared, len(data) - 1)
            shared += (data[a] == data[b]) & (data[a] != _TERMINATOR)
        return shared

    def matching(self) -> np.ndarray:
        """For each ranked place the longest match that begins anywhere else."""
        best = np.zeros(len(self.places), np.int64)
        for samples, prefix in ((self.heads, self.head_prefix), (self.tails, self.tail_prefix)):
            at = np.argsort(samples)
            samples, prefix = samples[at], prefix[at]
            last = np.searchsorted(samples, self.places, "right") - 1
            best = np.maximum(best, prefix[last] - (self.places - samples[last]))
        return best


def repeated_strings(pieces: list[bytes], weights: np.ndarray, length: int) -> list[np.ndarray]:
    """For each distinct piece, which of its strings occur again in any piece."""
    index = RunLengthIndex(pieces, length)
    again = (index.matching() >= length) | np.repeat(weights > 1, index.counts)
    return np.split(again, np.cumsum(index.counts)[:-1])


def repeated_in_parts(pieces: list[bytes], weights: np.ndarray, length: int, anchor: int) -> list[np.ndarray]:
    """As ``repeated_strings``, indexing at most about ``INDEX_BYTES`` at a time.

    Equal strings lie alike about their anchor. Strings that begin within ``_NEAR`` bytes of
    each other share most of their bytes; pieces are cut into such runs, and runs are
    told apart by these shared bytes, so equal strings are indexed together.
    """
    if sum(map(len, pieces)) <= 2 * INDEX_BYTES:
        return repeated_strings(pieces, weights, length)
    data = np.frombuffer(b"".join(pieces), np.uint8)
    offsets = np.append(0, np.cumsum([len(p) for p in pieces]))
    _, strings, texts, place = anchor_places(data, offsets, length, anchor)
    part = (place - strings) // _NEAR
    new = np.flatnonzero(np.r_[True, (texts[1:] != texts[:-1]) | (place[1:] != place[:-1]) | (part[1:] != part[:-1])])
    sizes = np.diff(np.append(new, len(strings)))
    begin = strings[new]
    sums = prefix_hash(data)
    # bytes that all strings of this place and part share, whichever of them a piece holds
    core = place[new] - part[new] * _NEAR
    keys = span_hash(sums, core, core - (_NEAR - 1) + length) ^ part[new].astype(np.uint64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    again = np.zeros(len(strings), bool)
    raw = data.tobytes()
    at = 0
    while at < len(order):
        numbers: dict[bytes, int] = {}
        totals: list[int] = []
        members: list[tuple[int, int]] = []
        size = 0
        while at < len(order) and (size < INDEX_BYTES or keys[at] == keys[at - 1]):
            run = int(order[at])
            text = raw[begin[run] : begin[run] + sizes[run] + length - 1]
            number = numbers.setdefault(text, len(numbers))
            if number == len(totals):
                totals.append(0)
                size += len(text)
            totals[number] += int(weights[texts[new[run]]])
            members.append((run, number))
            at += 1
        found = repeated_strings(list(numbers), np.array(totals), length)
        for run, number in members:
            again[new[run] : new[run] + sizes[run]] = found[number]
    return np.split(again, np.cumsum([max(len(p) - length + 1, 0) for p in pieces])[:-1])


def _runs(flags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of runs of each array, and all runs' begins and ends."""
    sizes = np.array([len(f) for f in flags], np.int64)
    begins = np.cumsum(sizes + 1) - sizes
    laid = np.zeros(int(sizes.sum()) + len(flags) + 1, np.int8)
    laid[ragged(begins, sizes)] = np.concatenate([*flags, np.zeros(0, bool)])
    steps = np.diff(laid)
    first, end = np.flatnonzero(steps == 1) + 1, np.flatnonzero(steps == -1) + 1
    owner = np.searchsorted(begins, first, "right") - 1
    return np.bincount(owner, minlength=len(flags)), first - begins[owner], end - begins[owner]


_SPANS = T.StructType(_long(*_ID, "begin", "end"))


def _indexed(pieces: DataFrame, length: int, anchor: int) -> DataFrame:
    """Repeated spans of the pieces of whole buckets."""

    def mark(rows: list[tuple]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = {}
        weights: list[int] = []
        which = []
        for row in rows:
            n = numbers.setdefault(row[5], len(numbers))
            if n == len(weights):
                weights.append(0)
            weights[n] += row[4]
            which.append(n)
        counts, begins, ends = _runs(repeated_in_parts(list(numbers), np.array(weights), length, anchor))
        own = np.array(which, np.int64)
        at = ragged((np.cumsum(counts) - counts)[own], counts[own])
        first, *ids = (np.repeat(np.array([r[k] for r in rows], np.int64), counts[own]) for k in (3, 1, 2))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*ids, first + begins[at], first + ends[at] + length - 1)], _SPANS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size > INDEX_BYTES and row[0] != held[-1][0]:
                    yield mark(held)
                    held, size = [], 0
                if not held or held[-1][5] != row[5]:
                    size += len(row[5])
                held.append(row)
        if held:
            yield mark(held)

    return pieces.select("h", *_ID, "first", "copies", "piece").repartition("h").sortWithinPartitions("h", "piece").mapInArrow(run, _SPANS)


def _counted(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated spans of pieces in buckets too large for one task, by counting strings."""
    named = pieces.withColumns({"p1": F.xxhash64("piece"), "p2": F.xxhash64(F.lit(1), "piece")})
    distinct = named.groupBy("p1", "p2").agg(F.first("piece").alias("piece"), F.sum("copies").alias("copies"))
    schema = T.StructType(_long("p1", "p2", "copies", "place", "s1", "s2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(2), 1 << 16):
                counts = np.maximum(np.diff(offsets) - length + 1, 0)
                starts = ragged(offsets[:-1], counts)
                owner = pa.array(np.repeat(np.arange(row, end), counts))
                hashes = [span_hash(prefix_hash(d), starts, starts + length).view(np.int64) for d in (data, data ^ 0x5A)]
                columns = [batch.column(0).take(owner), batch.column(1).take(owner), batch.column(3).take(owner), pa.array(ragged(np.zeros(len(counts), np.int64), counts))]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, hashes)], schema.names)

    strings = distinct.select("p1", "p2", "piece", "copies").mapInArrow(run, schema)
    again = strings.groupBy("s1", "s2").agg(F.sum("copies").alias("n")).where("n > 1").select("s1", "s2")
    places = strings.join(again, ["s1", "s2"]).groupBy("p1", "p2").agg(F.sort_array(F.collect_list("place")).alias("places"))
    spans = named.select("p1", "p2", *_ID, "first").join(places, ["p1", "p2"]).select(*_ID, "first", F.explode("places").alias("place"))
    return spans.select(*_ID, (F.col("first") + F.col("place")).alias("begin"), (F.col("first") + F.col("place") + length).alias("end"))


# ---------------------------------------------------------------- whole job


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, bucket: int = BUCKET_PIECES) -> DataFrame:
    """Spans of repeated bytes by text identity; spans of one text may touch or overlap."""
    long_enough = _identified(docs.select(text).where(F.octet_length(F.col(f"`{text}`")) >= length), text)
    texts = long_enough.select(*_ID, F.col(f"`{text}`").alias("text"))
    anchors = stored(_anchors(texts, length, anchor), "anchors")
    seen = anchors.groupBy("h").agg(F.sum("anchors").alias("n")).where("n > 1")
    wanted = (
        anchors.join(seen, "h")
        .groupBy(*_ID)
        .agg(F.collect_set(F.struct("h", "first", "strings", (F.col("n") > bucket).alias("hot"))).alias("wanted"))
    )
    distinct = texts.groupBy(*_ID).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    pieces = _cut(distinct.join(wanted, _ID), length)
    few = _indexed(pieces.where("not hot"), length, anchor)
    if seen.where(F.col("n") > bucket).isEmpty():
        return stored(few, "spans")
    pieces = stored(pieces, "pieces")
    return stored(_indexed(pieces.where("not hot"), length, anchor).unionByName(_counted(pieces.where("hot"), length)), "spans")


def _merged(begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for begin, end in sorted(zip(begins.tolist(), ends.tolist())):
        if spans and begin <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((begin, end))
    return spans


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, keep_text: bool = True, **options) -> DataFrame:
    """The documents with repeated bytes removed, and per document ``n_bytes``, ``n_removed``,
    ``n_spans`` and the remaining bytes' ``kept_sha256``.

    A byte goes when it lies in a ``length``-byte string that starts anywhere else too, in
    the same or another text, judged on the texts as they came. ``keep_text=False``
    leaves the text column out.
    """
    spans = repeated_spans(docs, text, length, **options)
    lists = spans.groupBy(*_ID).agg(F.collect_set(F.struct("begin", "end")).alias("__spans"))
    kept = [c for c in docs.columns if c not in _RESULTS and (keep_text or c != text)]
    own = {"n_bytes": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept_sha256": T.StringType()}
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, t) for n, t in own.items()])
    named = _identified(docs, text).join(lists, _ID, "left").select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"), "__spans")
    at_text = kept.index(text) if keep_text else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = []
            texts = batch.column(len(kept))
            lists_ = batch.column(len(kept) + 1)
            offsets = lists_.offsets.to_numpy()
            begins, ends = (x.to_numpy() for x in lists_.values.flatten())
            for n in range(len(batch)):
                value = texts[n].as_py()
                raw = (value or "").encode()
                a, b = offsets[n], offsets[n + 1]
                cuts = _merged(begins[a:b], ends[a:b]) if lists_[n].is_valid else []
                edges = [0, *[x for cut in cuts for x in cut], len(raw)]
                rest = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])) if cuts else raw
                results.append((rest.decode("utf-8", "ignore") if cuts else value, len(raw), len(raw) - len(rest), len(cuts), hashlib.sha256(rest).hexdigest()))
            columns = [batch.column(k) for k in range(len(kept))]
            new = list(zip(*results)) or [[]] * 5
            if keep_text:
                columns[at_text] = pa.array(new[0], pa.string())
            own_columns = [pa.array(new[k], pa.int64()) for k in (1, 2, 3)] + [pa.array(new[4], pa.string())]
            yield pa.RecordBatch.from_arrays(columns + own_columns, schema.names)

    return named.mapInArrow(run, schema)
