"""Vectorised helpers over blocks of whole texts inside Arrow tasks.

A block is a run of rows whose UTF-8 bytes lie in one array; a text is never cut,
so a block holds at least one whole text and otherwise at most ``limit`` bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

BLOCK_BYTES = 1 << 20

BASE = 0x9E3779B97F4A7C15
_U64 = np.uint64
_powers = {"up": np.ones(1, _U64), "down": np.ones(1, _U64)}


def text_blocks(values: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` per block; a NULL text is empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = pc.fill_null(values.cast(pa.binary()).cast(pa.large_binary()), b"")
    rows = len(values)
    if not rows:
        return
    buffers = values.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[values.offset : values.offset + rows + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    values = values ^ (values >> _U64(30))
    values = values * _U64(0xBF58476D1CE4E5B9)
    values ^= values >> _U64(27)
    values *= _U64(0x94D049BB133111EB)
    values ^= values >> _U64(31)
    return values


def _power(kind: str, size: int) -> np.ndarray:
    known = _powers[kind]
    if len(known) < size:
        step = BASE if kind == "up" else pow(BASE, -1, 1 << 64)
        factors = np.full(max(size, BLOCK_BYTES + 1), step, _U64)
        factors[0] = 1
        known = _powers[kind] = np.multiply.accumulate(factors)
    return known


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums, from which any span's hash follows."""
    sums = np.zeros(len(data) + 1, _U64)
    np.cumsum((data.astype(_U64) + _U64(1)) * _power("up", len(data))[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; equal bytes give equal hashes anywhere."""
    down = _power("down", len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def every_gram_hash(sums: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes from each position."""
    count = len(sums) - size
    if count <= 0:
        return np.zeros(0, _U64)
    return mix((sums[size:] - sums[:-size]) * _power("down", len(sums))[:count])


def find_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each text.

    ``is_word`` tells for each of the 256 byte values whether it belongs to a word;
    words end with their text. The third array has one entry more than texts.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = is_word[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return starts, ends, np.searchsorted(starts, offsets)


def byte_table(pattern_bytes: bytes, inside: bool = True) -> np.ndarray:
    """A 256-entry table that is ``inside`` at the given byte values."""
    table = np.full(256, not inside)
    table[list(pattern_bytes)] = inside
    return table


#: Fixed: words are runs without blank, tab, line and form feeds, or carriage return.
SPACE_WORDS = byte_table(b" \t\n\x0b\x0c\r", inside=False)


def word_grams(hashes: np.ndarray, firsts: np.ndarray, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and first word of each run of ``size`` words within a text.

    With ``short``, a text of fewer words, but not none, is one run.
    """
    counts = np.diff(firsts)
    texts = np.repeat(np.arange(len(counts)), np.maximum(counts - size + 1, 0))
    total = len(hashes) - size + 1
    grams = np.zeros(max(total, 0), _U64)
    for k in range(size):
        if total > 0:
            grams += hashes[k : k + total] * _power("up", size + 2)[k + 1]
    places = np.concatenate([np.arange(0)] + [ragged(firsts[:-1], np.maximum(counts - size + 1, 0))])
    grams = mix(grams[places])
    if short and (few := np.flatnonzero((counts > 0) & (counts < size))).size:
        own = np.array(
            [sum(int(h) * pow(BASE, k + 1, 1 << 64) for k, h in enumerate(hashes[firsts[t] : firsts[t + 1]])) & (2**64 - 1) for t in few],
            _U64,
        )
        own = mix(own + _U64(1))
        texts, places, grams = np.r_[texts, few], np.r_[places, firsts[few]], np.r_[grams, own]
        order = np.argsort(texts, kind="stable")
        texts, places, grams = texts[order], places[order], grams[order]
    return grams, texts, places


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``counts[i]`` values, for all i in a row."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in any span ``[start, end)``."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps)[:-1] > 0


def map_texts(
    docs: DataFrame,
    text: str,
    fields: list[T.StructField],
    work: Callable[[np.ndarray, np.ndarray], list[pa.Array]],
    keep_text: bool = False,
    limit: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows with the columns that ``work(bytes, offsets)`` gives for each block.

    New columns replace old ones of the same name; order and number of rows stay.
    """
    own = {f.name for f in fields}
    kept = [c for c in docs.columns if c not in own and (keep_text or c != text)]
    schema = T.StructType([docs.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_blocks(batch.column(len(kept)), limit):
                old = [batch.column(k).slice(row, end - row) for k in range(len(kept))]
                yield pa.RecordBatch.from_arrays(old + work(data, offsets), schema.names)

    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)
