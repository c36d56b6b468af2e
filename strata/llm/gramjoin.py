"""Exact similarity join of documents by the Jaccard similarity of their word shingles.

A document is the set of its distinct four-word shingles. Sets are dealt into bands of
size. For two sets of a band (or of it and the next) that are similar enough, the symmetric
difference has at most D members, D following from the band's sizes. Every set is cut
into slightly more than D + 1 slices by a hash of the shingles; similar sets then agree in
a slice that is not empty, so the pair meets in that slice's tile. A set with too few
slices that hold anything for this to be certain is sliced anew by another hash.

Inside a tile, size and hashed bitmaps come first: where two bitmaps differ in b bits, the
sets differ in at least b shingles, so the overlap is at most (m + n - b) / 2. Only pairs that
pass are intersected exactly, as sorted arrays. Every set is first held against one tile's least
member, the one it shares most tiles with. In tiles that then still hold several components, bitmaps
are compared inside tasks; sets connected by pairs that these leave open are gathered,
over all tiles, and intersected inside a task, but for pairs of one component. A group too large
for a task is dealt into parts, every two of which meet in a task of their own. No link is lost on the way.

Shingles are told apart by 64-bit hashes (words by 64-bit BLAKE2 first), sets by 128 bits.

Defined cases: words are lower-cased over A-Z only; fewer than four words are one shingle;
a text without words, NULL included, has the empty set, links with nothing and is its own
component; repeated rows and equal texts share a component; a NULL key gives a NULL
component only if no row of the component has a key. Other columns stay, but for those named as
results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from strata.llm.components import components
from strata.llm.store import stored
from strata.llm.textops import SPACE_WORDS, find_words, map_texts, mix, ragged, word_grams

SHINGLE = 4
#: Similarity that links two documents, as a fraction.
SIMILAR = (17, 20)
#: A band's greatest size over its least.
BAND_RATIO = 1.6
#: Hashes by which a set is sliced, at most; beyond them sets meet in a tile of their band.
SLICINGS = 16
#: Members, and shingles of all members, that one task compares.
TILE_MEMBERS = 4_000
TILE_SHINGLES = 4_000_000

_U64 = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; a block's different words are hashed once."""
    sizes = ends - starts
    if not len(sizes):
        return np.zeros(0, _U64)
    letters = np.ascontiguousarray(data[ragged(starts, sizes)])
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    hashed = b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in coded.dictionary.to_pylist())
    return np.frombuffer(hashed, _U64)[coded.indices.to_numpy()]


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and shingle of each distinct shingle of each text, in order."""
    lowered = _LOWER[data]
    starts, ends, firsts = find_words(lowered, offsets, SPACE_WORDS)
    grams, texts, _ = word_grams(word_hashes(lowered, starts, ends), firsts, SHINGLE)
    order = np.lexsort((grams, texts))
    grams, texts = grams[order], texts[order]
    if len(grams):
        new = np.r_[True, (grams[1:] != grams[:-1]) | (texts[1:] != texts[:-1])]
        grams, texts = grams[new], texts[new]
    return texts, grams


class Bands:
    """Bands of set sizes: their bounds, slices and bitmap widths."""

    def __init__(self, largest: int) -> None:
        low, self.lows, self.highs = 1, [], []
        while low <= largest:
            high = int(low * BAND_RATIO)
            self.lows.append(low)
            self.highs.append(high)
            low = high + 1
        self.differing = [self._differing(h) for h in self.highs]
        self.slices = [self._slices(low, d) for low, d in zip(self.lows, self.differing)]
        # bits of the bitmap of a set whose own band it is; powers of two, so that wider ones fold
        self.bits = [64 << max(0, (h - 1).bit_length() - 6) for h in self.highs]

    @staticmethod
    def _differing(size: int) -> int:
        """Most shingles by which a set of ``size`` and a similar one at least as large differ."""
        share, whole = SIMILAR
        both = size + size * whole // share
        return both * (whole - share) // (whole + share)

    @staticmethod
    def _slices(size: int, differing: int) -> int:
        """Slices of which a set of ``size`` fills more than ``differing`` nearly always."""
        n = differing + 1
        while differing:
            load = size / n
            empty = np.exp(-load)
            spread = np.sqrt(max(n * (empty - (1 + load) * empty**2), 0.0))
            if n * (1 - empty) - 2 * spread >= differing + 1 or n >= 4 * (differing + 1):
                break
            n += 1
        return n

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.array(self.highs), sizes)

    def roles(self, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sets and bands in whose tiles they belong: their own, and lower ones that hold similar sets."""
        highs = np.array(self.highs)
        some = np.flatnonzero(sizes > 0)
        band = self.of(sizes[some])
        while len(some):
            yield some, band
            some, band = some[band > 0], band[band > 0] - 1
            near = highs[band] * SIMILAR[1] >= sizes[some] * SIMILAR[0]
            some, band = some[near], band[near]


def tiles_of(texts: np.ndarray, grams: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Set and tile of each slice that is not empty, for all bands in which a set has a place."""
    firsts = np.cumsum(sizes) - sizes
    owners, tiles = [], []
    for some, band in bands.roles(sizes):
        slices, differing = np.array(bands.slices)[band], np.array(bands.differing)[band]
        for seed in range(SLICINGS):
            own = np.repeat(np.arange(len(some)), sizes[some])
            shingles = grams[ragged(firsts[some], sizes[some])]
            begins = np.cumsum(slices) - slices
            mixed = mix(shingles + _U64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            place = begins[own] + (mixed % slices.astype(_U64)[own]).astype(np.int64)
            sums = np.zeros(int(slices.sum()), _U64)
            np.add.at(sums, place, mix(mixed))
            filled = np.bincount(place, minlength=len(sums)) > 0
            owner = np.repeat(np.arange(len(some)), slices)
            label = (np.arange(len(sums)) - begins[owner]) + (band[owner].astype(np.int64) << 32) + (seed << 48)
            owners.append(some[owner[filled]])
            tiles.append(mix(sums[filled] ^ mix(label[filled].astype(_U64))))
            sparse = np.bincount(owner[filled], minlength=len(some)) <= differing
            some, band, slices, differing = some[sparse], band[sparse], slices[sparse], differing[sparse]
            if not len(some):
                break
        owners.append(some)
        tiles.append(mix(band.astype(_U64) + _U64(1 << 63)))
    owner, tile = np.concatenate(owners or [np.zeros(0, np.int64)]), np.concatenate(tiles or [np.zeros(0, _U64)])
    order = np.argsort(owner, kind="stable")
    return owner[order], tile[order]


def bitmaps_of(texts: np.ndarray, grams: np.ndarray, sizes: np.ndarray, bands: Bands) -> list[bytes]:
    """Each set's bitmap: a bit is on if an odd number of shingles fall on it."""
    bits = np.where(sizes > 0, np.array(bands.bits + [64])[np.minimum(bands.of(sizes), len(bands.bits))], 0)
    begins = np.cumsum(bits) - bits
    place = begins[texts] + (mix(grams) & (bits[texts] - 1).astype(_U64)).astype(np.int64)
    odd = (np.bincount(place, minlength=int(bits.sum())) & 1).astype(np.uint8)
    packed = np.packbits(odd, bitorder="little").tobytes()
    return [packed[b // 8 : (b + n) // 8] for b, n in zip(begins.tolist(), bits.tolist())]


def folded(bitmap: bytes, size: int) -> np.ndarray:
    """A bitmap of ``size`` bytes that the given wider one stands for."""
    words = np.frombuffer(bitmap, _U64)
    return np.bitwise_xor.reduce(words.reshape(-1, size // 8), axis=0)


def most_overlap(m: np.ndarray, n: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap of sets whose bitmaps differ in ``bits``."""
    return np.minimum((m + n - bits) // 2, np.minimum(m, n))


def enough(overlap: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Whether sets of ``both`` members in all are similar enough with that overlap."""
    return (overlap > 0) & (overlap * SIMILAR[1] >= (both - overlap) * SIMILAR[0])


def _marked(docs: DataFrame, text: str, keep_text: bool) -> DataFrame:
    """The documents with their set's name, size, bitmap and tiles; the empty set has no name.

    Of equal sets, the first of a task has the tiles, so a hot text goes into a tile once a task.
    """
    fields = [
        T.StructField("__node", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("__bitmap", T.BinaryType()),
        T.StructField("__tiles", T.ArrayType(T.LongType())),
    ]

    placed: set[bytes] = set()  # sets that this task has put into their tiles already

    def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        count = len(offsets) - 1
        texts, grams = shingle_sets(data, offsets)
        sizes = np.bincount(texts, minlength=count)
        bands = Bands(max(int(sizes.max()), 1))
        names = np.zeros((count, 2), _U64)
        for k, seed in enumerate((0x2545F4914F6CDD1D, 0x9E6C63D0876A9A35)):
            np.add.at(names[:, k], texts, mix(grams ^ _U64(seed)))
        nodes = [n.tobytes() if s else None for n, s in zip(names, sizes.tolist())]
        fresh = np.zeros(count, bool)
        for k, node in enumerate(nodes):
            if node is not None and node not in placed:
                placed.add(node)
                fresh[k] = True
        owner, tile = tiles_of(texts, grams, sizes, bands)
        owner, tile = owner[fresh[owner]], tile[fresh[owner]]
        ends = np.append(0, np.cumsum(np.bincount(owner, minlength=count)))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tile.view(np.int64)))
        return [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bitmaps_of(texts, grams, sizes, bands), pa.binary()), lists]

    named = docs.withColumn("__text_name", F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))))
    return map_texts(named, text, fields, work, keep_text=keep_text)


def _members(marked: DataFrame) -> DataFrame:
    """``tile`` and ``node`` of tiles with different sets; of tiles with the same sets one stays.

    Sets are dealt by tile once, and what is alone in its tile goes no further.
    """
    placed = marked.select(F.col("__node").alias("node"), F.explode("__tiles").alias("tile"))
    tile = Window.partitionBy("tile")
    short = F.xxhash64("node")
    met = placed.withColumns({"lo": F.min(short).over(tile), "hi": F.max(short).over(tile)}).where("lo != hi")
    several = stored(met.select("tile", "node").distinct(), "met")
    # 32 bits a sum, so that no number of rows overflows it
    sums = [F.sum(short.bitwiseAND(F.lit(0xFFFFFFFF))).alias("s1"), F.sum(F.shiftrightunsigned(short, 32)).alias("s2")]
    held = several.groupBy("tile").agg(F.min(short).alias("lo"), F.max(short).alias("hi"), F.count(F.lit(1)).alias("n"), *sums)
    once = held.groupBy("lo", "hi", "n", "s1", "s2").agg(F.min("tile").alias("tile")).select("tile")
    return several.join(once, "tile")


def _sets(members: DataFrame, marked: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``node``, ``grams`` (ascending) of the sets in tiles, from one of their texts each."""
    wanted = members.select(F.col("node").alias("__node")).distinct()
    own = marked.select("__node", "__text_name").join(wanted, "__node").groupBy("__node").agg(F.min("__text_name").alias("name"))
    named = docs.select(F.col(f"`{text}`").alias("text"), F.unhex(F.md5(F.col(f"`{text}`"))).alias("name"))
    texts = named.join(stored(own, "names"), "name").groupBy(F.col("__node").alias("node")).agg(F.first("text").alias("text"))

    def work(data: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        owner, grams = shingle_sets(data, offsets)
        ends = np.append(0, np.cumsum(np.bincount(owner, minlength=len(offsets) - 1)))
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(grams.view(np.int64)))]

    return map_texts(texts, "text", [T.StructField("grams", T.ArrayType(T.LongType()))], work)


_PAIR = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _both(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """The pairs with both nodes' columns."""
    for side in ("a", "b"):
        pairs = pairs.join(table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs.select("a", "b", *[f"{c}_{side}" for c in columns for side in ("a", "b")])


def _bounded(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs that sizes and bitmaps do not rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            bits = np.zeros(len(m), np.int64)
            for k, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                size = min(len(x), len(y))
                bits[k] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum()
            good = pa.array(enough(most_overlap(m, n, bits), m + n))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], _PAIR.names)

    return _both(pairs, marks, "n", "bitmap").mapInArrow(run, _PAIR)


def _intersected(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for k in (2, 3):
                lists = batch.column(k)
                sides.append((lists.offsets.to_numpy(), lists.values.to_numpy()))
            (oa, va), (ob, vb) = sides
            good = []
            for k in range(len(batch)):
                x, y = va[oa[k] : oa[k + 1]], vb[ob[k] : ob[k + 1]]
                good.append(bool(enough(np.int64(_overlap(x, y)), len(x) + len(y))))
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], _PAIR.names)

    return _both(pairs, sets, "grams").mapInArrow(run, _PAIR)


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Members that two ascending sets of unsigned values, held as signed ones, share."""
    return len(np.intersect1d(x, y, assume_unique=True))


class Tile:
    """One tile's members, those of its largest component first: they need no comparison among themselves."""

    def __init__(self, roots: list[bytes], sizes: list[int], bitmaps: list[bytes]) -> None:
        own, counts = np.unique(np.array([r.hex() for r in roots]), return_inverse=True, return_counts=True)[1:]
        self.order = np.lexsort((own, -counts[own]))
        self.first = int(counts.max())
        self.own, self.sizes = own[self.order], np.array(sizes)[self.order]
        width = min(len(b) for b in bitmaps)
        self.marks = np.stack([folded(bitmaps[k], width) for k in self.order])

    def near(self, n: int) -> np.ndarray:
        """Earlier members of other components that size and bitmap allow to be similar."""
        sizes = self.sizes
        near = np.flatnonzero((self.own[:n] != self.own[n]) & enough(np.minimum(sizes[:n], sizes[n]), sizes[:n] + sizes[n]))
        bits = np.bitwise_count(self.marks[near] ^ self.marks[n]).sum(axis=1).astype(np.int64)
        return near[enough(most_overlap(sizes[near], sizes[n], bits), sizes[near] + sizes[n])]

    def chains(self) -> list[tuple[int, int]]:
        """Pairs that bitmaps leave open, as few as connect all members that such pairs connect."""
        found, label = [], np.arange(len(self.own))
        for n in range(self.first, len(self.own)):
            near = self.near(n)
            for joined, m in zip(*np.unique(label[near], return_index=True)):
                if joined != label[n]:
                    found.append((int(self.order[near[m]]), int(self.order[n])))
                    label[label == joined] = label[n]
        return found

    def links(self, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """Links, as few as join all components that the tile's links join."""
        own, order, sizes, found = self.own, self.order, self.sizes, []
        for n in range(self.first, len(own)):
            for m in self.near(n).tolist():
                if own[m] != own[n] and enough(np.int64(_overlap(sets[order[m]], sets[order[n]])), sizes[m] + sizes[n]):
                    found.append((int(order[m]), int(order[n])))
                    own[own == own[m]] = own[n]
        return found


def _dealt(members: DataFrame, roots: DataFrame, marks: DataFrame) -> DataFrame:
    """Members of tiles that hold several components, once for each task they are to be in.

    Members of a tile's largest component need not meet each other: each is in one task, and the
    others visit all of these. Where the others are too many for that, every two parts of the tile meet.
    """
    placed = members.join(roots, "node", "left").join(marks.select("node", "n"), "node").withColumn("root", F.coalesce("root", "node"))
    held = placed.groupBy("tile", "root").agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("shingles"))
    tiles = held.groupBy("tile").agg(
        F.max(F.struct("count", "shingles", "root")).alias("main"),
        F.sum("count").alias("count"),
        F.sum("shingles").alias("shingles"),
        F.count(F.lit(1)).alias("components"),
    )
    # what meets in a task is two parts, or a part and the visitors, each at most half of what it may hold
    parts = "cast(ceil(greatest({0} * 2 / {m}, {1} * 2 / {s})) AS int)"
    limits = {"m": TILE_MEMBERS, "s": TILE_SHINGLES}
    several = tiles.where("components > 1").selectExpr(
        "tile",
        "main.root AS main",
        f"count <= {TILE_MEMBERS} AND shingles <= {TILE_SHINGLES} AS whole",
        f"(count - main.count) * 2 <= {TILE_MEMBERS} AND (shingles - main.shingles) * 2 <= {TILE_SHINGLES} AS visited",
        f"greatest({parts.format('main.count', 'main.shingles', **limits)}, 1) AS homes",
        f"greatest({parts.format('count', 'shingles', **limits)}, 2) AS parts",
    )
    mixed = placed.join(several, "tile")
    part = F.expr("cast(pmod(xxhash64(node), CASE WHEN visited THEN homes ELSE parts END) AS int)")
    tasks = F.expr(
        """CASE WHEN whole THEN array(named_struct('x', 0, 'y', 0))
        WHEN visited AND root = main THEN array(named_struct('x', part, 'y', part))
        WHEN visited THEN transform(sequence(0, homes - 1), p -> named_struct('x', p, 'y', p))
        ELSE transform(filter(sequence(0, parts - 1), p -> p != part), p -> named_struct('x', least(p, part), 'y', greatest(p, part))) END"""
    )
    return mixed.withColumn("part", part).select("tile", F.explode(tasks).alias("t"), "node", "root").select("tile", "t.x", "t.y", "node", "root")


def _groups(batches: Iterator[pa.RecordBatch], sets: bool) -> Iterator[tuple[list, list[tuple], list[np.ndarray]]]:
    """Each tile's place and members (node, root, size, bitmap), with their sets if they are there."""
    held, arrays, tile = [], [], None
    for batch in batches:
        if sets:
            offsets, values = batch.column(7).offsets.to_numpy(), batch.column(7).values.to_numpy()
        for row, (*place, node, root, size, bitmap) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(7)))):
            if place != tile:
                if len(held) > 1:
                    yield tile, held, arrays
                tile, held, arrays = place, [], []
            held.append((node, root, size, bitmap))
            if sets:
                # a copy, so that a tile held on to does not keep its batches
                arrays.append(values[offsets[row] : offsets[row + 1]].copy())
    if len(held) > 1:
        yield tile, held, arrays


def _by_tile(members: DataFrame) -> DataFrame:
    return members.repartition("tile", "x", "y").sortWithinPartitions("tile", "x", "y", "node")


def _open_pairs(dealt: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs of different components that bitmaps leave open, enough to connect all such members of a tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, _ in _groups(batches, sets=False):
            nodes, roots, sizes, bitmaps = zip(*held)
            pairs = Tile(roots, sizes, bitmaps).chains()
            yield pa.RecordBatch.from_arrays([pa.array([nodes[p[k]] for p in pairs], pa.binary()) for k in (0, 1)], _PAIR.names)

    rows = dealt.join(marks.select("node", "n", "bitmap"), "node")
    return _by_tile(rows.select("tile", "x", "y", "node", "root", "n", "bitmap")).mapInArrow(run, _PAIR)


def _within(dealt: DataFrame, marks: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of different components inside tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held, arrays in _groups(batches, sets=True):
            nodes, roots, sizes, bitmaps = zip(*held)
            pairs = Tile(roots, sizes, bitmaps).links(arrays)
            yield pa.RecordBatch.from_arrays([pa.array([nodes[p[k]] for p in pairs], pa.binary()) for k in (0, 1)], _PAIR.names)

    rows = dealt.join(marks.select("node", "n", "bitmap"), "node").join(sets, "node")
    return _by_tile(rows.select("tile", "x", "y", "node", "root", "n", "bitmap", "grams")).mapInArrow(run, _PAIR)


def _links(marked: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """Verified links (a, b) between sets that join all that similar pairs join."""
    members = stored(_members(marked), "members")
    own = marked.where("n_shingles > 0").select(F.col("__node").alias("node"), F.col("n_shingles").alias("n"), F.col("__bitmap").alias("bitmap"))
    marks = stored(own.join(members.select("node").distinct(), "node").dropDuplicates(["node"]), "marks")
    sets = stored(_sets(members, marked, docs, text), "sets")
    centres = members.groupBy("tile").agg(F.min("node").alias("b"))
    shared = members.join(centres, "tile").where("node != b").groupBy("node", "b").agg(F.count(F.lit(1)).alias("n"))
    # the one centre that shares most tiles with a node; its other tiles are looked at below
    stars = shared.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("n", "b")).alias("most")).select("a", F.col("most.b").alias("b"))
    links = stored(_intersected(_bounded(stars, marks), sets), "links")
    roots = stored(components(links), "roots")
    dealt = stored(_dealt(members, roots, marks), "dealt")
    # sets that open pairs connect, over all tiles: each is sent once, whatever the number of its tiles
    clusters = components(stored(_open_pairs(dealt, marks), "open"))
    gathered = stored(clusters.select(F.xxhash64("root").alias("tile"), "node"), "gathered")
    again = stored(_dealt(gathered, roots, marks), "dealt")
    return links.unionByName(stored(_within(again, marks, sets), "links"))


def join(docs: DataFrame, text: str = "text", key: str = "doc_id", result: str = "component_id", keep_text: bool = True) -> DataFrame:
    """The documents with ``n_shingles`` and their component: the least key that links reach."""
    marked = stored(_marked(docs.drop(result), text, keep_text), "marked")
    roots = components(_links(marked, docs, text)).select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    ids = marked.where("n_shingles > 0").groupBy("__node").agg(F.min(F.col(f"`{key}`")).alias("__least"))
    placed = ids.join(roots, "__node", "left").withColumn("__root", F.coalesce("__root", "__node"))
    least = placed.groupBy("__root").agg(F.min("__least").alias("__component"))
    found = marked.join(placed.join(least, "__root").select("__node", "__component"), "__node", "left")
    kept = [F.col(f"`{c}`") for c in marked.columns if c not in ("__text_name", "__node", "__bitmap", "__tiles")]
    return found.select(*kept, F.when(F.col("n_shingles") > 0, F.col("__component")).otherwise(F.col(f"`{key}`")).alias(result))
