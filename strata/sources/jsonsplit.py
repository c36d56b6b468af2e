"""One large JSON document read by many tasks.

The document is an object with a ``records`` array of lists or objects. It is read as text that is cut behind
every bracket that ends a record, so Spark splits it like any text. Such a cut may lie inside a
string or inside a record, so a first pass finds, for each split, how it changes the depth of brackets and
whether it changes being inside a string, for both cases of how it begins; put together in
order, these few figures tell how every split begins. The second pass then gives out the
records that lie in one split, and a rest at its begin and end: those rests, at most two for each split,
are joined on the driver. What lies outside the records array comes back the same way.

An array before ``records`` is taken to begin in the same split as ``records`` does.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.sources.manifest import record_end
from strata.sources.scratch import written

_ESCAPED = re.compile(r"\\[\s\S]")
_OPENING = re.compile(r'(?<!\\)"records"\s*:\s*\[')
_BRACKET = re.compile(r"[\[\]{}]")
_BETWEEN = " ,\r\n\t"

RECORD, HEAD, INSIDE, TAIL, OUTER = range(5)


def _depth(text: str) -> tuple[int, int]:
    """Change of depth by a text outside strings, and the least depth on the way."""
    depth = least = 0
    for bracket in _BRACKET.findall(text):
        depth += 1 if bracket in "[{" else -1
        least = min(least, depth)
    return depth, least


def step(token: str) -> tuple[tuple[int, int], tuple[int, int], bool]:
    """Change of depth and least depth by a token that begins outside a string, and by one that begins
    inside, and whether it changes which."""
    parts = _ESCAPED.sub("", token).split('"')
    return _depth("".join(parts[::2])), _depth("".join(parts[1::2])), len(parts) % 2 == 0


def _splits(batches: Iterator[pa.RecordBatch], end: str) -> Iterator[tuple[int, Iterator[str]]]:
    """Each split's first byte and its tokens, in order."""

    def tokens() -> Iterator[tuple[int, str]]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    every = tokens()
    held = next(every, None)
    while held is not None:
        start = held[0]

        def own() -> Iterator[str]:
            nonlocal held
            while held is not None and held[0] == start:
                yield held[1] + end
                held = next(every, None)

        yield start, own()


def _figures(tokens: Iterator[str]) -> list[tuple[bool, int, int]]:
    """For a begin outside and inside a string: the end, the change of depth and the least depth on the way."""
    states = [[False, 0, 0], [True, 0, 0]]
    for token in tokens:
        outside, inside, turned = step(token)
        for state in states:
            change, least = inside if state[0] else outside
            state[2] = min(state[2], state[1] + least)
            state[1] += change
            state[0] ^= turned
    return [tuple(s) for s in states]


def begins(figures: list[tuple[int, list]]) -> dict[int, tuple[bool, int, bool]]:
    """Per split, by its first byte: begins in a string, at which depth, and inside the records."""
    found, inside, depth, opened, closed = {}, False, 0, False, False
    for start, (outer, inner) in sorted(figures):
        records = opened and not closed
        found[start] = inside, depth, records
        ends, change, least = inner if inside else outer
        closed = closed or (records and depth + least < 2)
        inside, depth = ends, depth + change
        opened = opened or depth >= 2
    return found


def cut(tokens: Iterator[str], inside: bool, depth: int, records: bool) -> Iterator[tuple[int, str]]:
    """The pieces of one split that begins as told."""
    rest, outer, done = "", "", False
    if records and (inside or depth > 2):
        for token in tokens:
            rest += token
            without, within, turned = step(token)
            depth += (within if inside else without)[0]
            inside ^= turned
            if not inside and depth <= 2:
                break
        else:
            yield INSIDE, rest
            return
        yield HEAD, rest
        rest = ""
    for token in tokens:
        if not records:
            opening = None if done else _OPENING.search(token)
            if opening is None:
                outer += token
                continue
            records = True
            outer, token = outer + token[: opening.end()], token[opening.end() :]
        rest += token
        record = rest.lstrip(_BETWEEN)
        if record.startswith("]"):
            records, done, outer, rest = False, True, outer + record, ""
            continue
        try:
            json.loads(record)
        except ValueError:
            continue
        yield RECORD, record
        rest = ""
    if rest.strip(_BETWEEN):
        yield TAIL, rest
    if outer:
        yield OUTER, outer


def stitched(rests: list[tuple[int, int, str]]) -> tuple[list[str], str]:
    """Records that lie in several splits, and what lies outside the records, from (first byte, kind, text) in order."""
    records, open_, outer = [], "", ""
    for _, kind, text in rests:
        if kind == OUTER:
            outer += text
        elif kind == HEAD:
            records.append((open_ + text).lstrip(_BETWEEN))
            open_ = ""
        else:
            open_ += text
    return records, outer


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """``value``, one row for the text of each record, and the document without its records."""
    end = record_end(spark, path)
    lines = spark.read.option("lineSep", end).text(path).select(F.col("_metadata.file_block_start").alias("start"), "value")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for start, tokens in _splits(batches, end):
            yield pa.RecordBatch.from_pylist([{"start": start, "figures": json.dumps(_figures(tokens))}])

    # a row of six numbers for each split
    figures = [(r["start"], json.loads(r["figures"])) for r in lines.mapInArrow(measure, "start long, figures string").collect()]
    state = begins(figures)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, str]] = []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held)) or [[], [], []]
            types = (pa.int64(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["start", "kind", "value"])

        for start, tokens in _splits(batches, end):
            for kind, text in cut(tokens, *state[start]):
                held.append((start, kind, text))
                if len(held) >= 4096:
                    yield batch()
                    held = []
        yield batch()

    parts = written(lines.mapInArrow(pieces, "start long, kind int, value string"), "json")
    rests = [tuple(r) for r in parts.where(F.col("kind") != RECORD).orderBy("start", "kind").collect()]
    records, outer = stitched(rests)
    try:
        head, _ = json.JSONDecoder().raw_decode(outer.strip())
    except ValueError as problem:
        raise ValueError(f"{path} is no JSON document: {problem}") from None
    if not isinstance(head, dict) or "records" not in head:
        raise ValueError(f"no records in {path}")
    whole = parts.where(F.col("kind") == RECORD).select("value")
    if records:
        whole = whole.unionByName(spark.createDataFrame([(r,) for r in records], "value string"))
    return whole, head
