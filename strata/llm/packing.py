"""Token sequences packed into rows of one length, best fit first.

Texts are encoded to token ids; a text longer than a row is cut into full rows and a
rest. A task gathers pieces up to ``GROUP_TOKENS``, sorts them by length, longest
first, and puts each into the row whose free space fits it most tightly. The tightest row is
found by a segment tree over the free spaces. Packing needs no shuffle, and each
group is packed from its own rows alone, so a lost task gives the same rows again.

A packed row holds the token ids, padded to the row's length, the running segment lengths
that begin with 0, positions that begin anew with every segment, and for each segment its
document and the first of that document's tokens in it; all tokens come out once.

Defined cases: NULL and empty texts have no tokens and are in no row; repeated rows are packed each;
a NULL doc_id is kept. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strata.llm.lexicon import VocabularyBox, worker_encoder
from strata.llm.textops import ragged, text_blocks

ROW_TOKENS = 2048
GROUP_TOKENS = 4 << 20
PAD = 0


class FreeSpaces:
    """Rows by their free space; a tree of counts finds the least space that fits."""

    def __init__(self, size: int) -> None:
        self.leaves = 1 << size.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, space: int, change: int) -> None:
        node = self.leaves + space
        while node:
            self.counts[node] += change
            node >>= 1

    def put(self, space: int, row: int) -> None:
        self.rows[space].append(row)
        self._add(space, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """A row of the least free space that is at least ``need``, and that space."""
        node = self.leaves + need
        if need >= self.leaves:
            return None
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.counts[node]:
                    node += 1
        space = node - self.leaves
        row = self.rows[space].pop()
        self._add(space, -1)
        return row, space


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Pieces of each row; longer pieces first, each into the tightest row that holds it."""
    free = FreeSpaces(length)
    rows: list[list[int]] = []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        found = free.take(size)
        row, space = found if found else (len(rows), length)
        if not found:
            rows.append([])
        rows[row].append(piece)
        if space > size:
            free.put(space - size, row)
    return rows


PACKED = T.StructType(
    [
        T.StructField("input_ids", T.ArrayType(T.IntegerType())),
        T.StructField("position_ids", T.ArrayType(T.IntegerType())),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("first_tokens", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.LongType()),
    ]
)
DIGESTS = T.StructType(
    [T.StructField("ids_sha256", T.StringType()), T.StructField("positions_sha256", T.StringType())] + [f for f in PACKED.fields if f.name not in ("input_ids", "position_ids")]
)


class _Group:
    """Pieces of a group of documents, flushed as packed rows."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.parts: list[tuple[np.ndarray, np.ndarray, list]] = []
        self.tokens = 0

    def add(self, ids: np.ndarray, begins: np.ndarray, docs: list) -> None:
        self.parts.append((ids, begins, docs))
        self.tokens += len(ids)

    def rows(self) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[list], list[np.ndarray]]:
        ids = np.concatenate([p[0] for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        docs = [d for p in self.parts for d in p[2]]
        sizes = np.concatenate([np.diff(p[1]) for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        begins = np.cumsum(sizes) - sizes
        pieces = -(-sizes // self.length)
        owner = np.repeat(np.arange(len(sizes)), pieces)
        first = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * self.length
        size = np.minimum(self.length, sizes[owner] - first)
        packed = best_fit(size, self.length)
        matrix = np.full((len(packed), self.length), PAD, np.int32)
        positions = np.zeros((len(packed), self.length), np.int32)
        cuts, names, firsts = [], [], []
        for n, row in enumerate(packed):
            own = size[row]
            total = int(own.sum())
            matrix[n, :total] = ids[ragged(begins[owner[row]] + first[row], own)]
            positions[n, :total] = ragged(np.zeros(len(row), np.int64), own)
            cuts.append(np.append(0, np.cumsum(own)))
            names.append([docs[o] for o in owner[row].tolist()])
            firsts.append(first[row])
        return matrix, positions, cuts, names, firsts


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array([list(v) for v in values], pa.list_(kind))


def pack(docs: DataFrame, vocabulary_path: str, length: int = ROW_TOKENS, group: int = GROUP_TOKENS, text: str = "text", key: str = "doc_id", digests: bool = False) -> DataFrame:
    """Packed rows; with ``digests`` the id matrix and positions are given by their SHA-256
    (little-endian 32-bit, the row's tokens without padding)."""
    box = VocabularyBox(docs.sparkSession, vocabulary_path)
    schema = DIGESTS if digests else PACKED

    def flush(held: _Group) -> Iterator[pa.RecordBatch]:
        matrix, positions, cuts, names, firsts = held.rows()
        for at in range(0, len(matrix), 256):
            part = slice(at, at + 256)
            ends = [int(c[-1]) for c in cuts[part]]
            tail = [_lists(cuts[part], pa.int32()), _lists(names[part], pa.int64()), _lists(firsts[part], pa.int64()), pa.array(ends, pa.int64())]
            if digests:
                head = [pa.array([hashlib.sha256(m[:e].tobytes()).hexdigest() for m, e in zip(x[part], ends)]) for x in (matrix, positions)]
            else:
                run = pa.array(np.arange(len(ends) + 1) * length, pa.int32())
                head = [pa.ListArray.from_arrays(run, pa.array(x[part].ravel())) for x in (matrix, positions)]
            yield pa.RecordBatch.from_arrays(head + tail, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(box, None)
        held = _Group(length)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for row, end, data, offsets in text_blocks(batch.column(1), 1 << 21):
                ids, begins = encoder.encode(data, offsets)
                held.add(ids.astype(np.int32), begins, names[row:end])
                if held.tokens >= group:
                    yield from flush(held)
                    held = _Group(length)
        yield from flush(held)

    return docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")).mapInArrow(run, schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """Packed rows as Parquet, one list column a matrix."""
    packed.write.parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PACKED).parquet(path)


def unpacked(packed: DataFrame) -> DataFrame:
    """``doc_id``, ``first_token`` and ``token_ids`` of every segment."""
    segments = packed.select(
        "input_ids", F.posexplode(F.arrays_zip("doc_ids", "first_tokens")).alias("n", "s"), "cu_seqlens"
    ).withColumns({"a": F.expr("cu_seqlens[n]"), "b": F.expr("cu_seqlens[n + 1]")})
    return segments.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.first_tokens").alias("first_token"), F.expr("slice(input_ids, a + 1, b - a)").alias("token_ids"))
