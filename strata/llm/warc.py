"""Zstandard-compressed WARC archives: written by Spark's text writer, read frame by frame.

An archive begins with a skippable frame that holds the compression dictionary; every record is
one frame after it. Tasks give the text writer one frame a row, and the line separator is an
empty skippable frame, so archives go through Spark's commit protocol to any storage that
Spark writes: files of lost or repeated attempts never appear.

Of records with equal payloads of at least ``REVISIT_BYTES`` the one with the largest page id
is the response and the others revisit it, without a block of their own. Readers take
the dictionary from the leading frame, walk the frames by their block headers, decode one
record at a time and check version, lengths, digests and the record's end.

Defined cases: a NULL html is the empty payload; rows with equal id and payload are all
responses, or all revisits, as their id decides; a NULL id is written as ``null``, read back as NULL and is
a revisit if a row with an id has its payload; a NULL URL is written as the record's id. An empty table gives
archives without records. Other columns are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from strata.llm.sampling import bounded
from strata.llm.store import new_folder

REVISIT_BYTES = 1000
#: Bounds of what the dictionary is trained on, and of its size.
TRAIN_PAGES = 800
TRAIN_BYTES = 8192
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
#: Fixed: magic numbers of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
#: Fixed: an empty skippable frame (0x184D2A50, length 0), as text.
SEPARATOR = "P*M\x18\0\0\0\0"
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
MAX_RECORD_BYTES = 1 << 30

RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


class BadArchive(ValueError):
    """An archive that breaks the format."""


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:page:{'null' if page is None else page}:{digest}>"


def build_record(page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, date: str = DATE) -> bytes:
    """A whole record; one that refers to another page has no payload of its own."""
    name = record_id(page, digest)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", name),
        ("WARC-Date", date),
        ("WARC-Target-URI", name[1:-1] if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
    ]
    block = b""
    if refers_to is None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
        fields.append(("Content-Type", "application/http;msgtype=response"))
    else:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", record_id(refers_to, digest)))
    fields.append(("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()))
    fields.append(("Content-Length", str(len(block))))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


_PAGE = re.compile(r"<urn:page:(null|-?\d+):([0-9a-f]{40})>")


def _page_of(name: str) -> tuple[int | None, str]:
    found = _PAGE.fullmatch(name)
    if not found:
        raise BadArchive(f"strange record id {name!r}")
    return (None if found[1] == "null" else int(found[1])), found[2]


def parse_record(record: bytes) -> dict:
    """The record's fields, after its lengths and digests have been checked."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise BadArchive(f"not a record: {record[:40]!r}")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.decode().partition(": ")
        if not colon or key.lower() in fields:
            raise BadArchive(f"bad header line {line!r}")
        fields[key.lower()] = value
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise BadArchive(f"{fields['warc-record-id']}: the block is not {size} bytes long")
    if fields["warc-block-digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise BadArchive(f"{fields['warc-record-id']}: the block's digest differs")
    page, digest = _page_of(fields["warc-record-id"])
    if fields["warc-payload-digest"] != f"sha1:{digest}":
        raise BadArchive(f"{fields['warc-record-id']}: the payload's digests differ")
    kind, payload, length, refers_to = fields["warc-type"], None, int(fields["x-payload-length"]), None
    if kind == "response":
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = re.search(rb"\r\ncontent-length: (\d+)", http.lower())
        if not http.startswith(b"HTTP/1.1 ") or not stated or not len(payload) == int(stated[1]) == length:
            raise BadArchive(f"{fields['warc-record-id']}: the payload's length differs")
        if hashlib.sha1(payload).hexdigest() != digest:
            raise BadArchive(f"{fields['warc-record-id']}: the payload's digest differs")
    elif kind == "revisit":
        refers_to, other = _page_of(fields["warc-refers-to"])
        if block or other != digest:
            raise BadArchive(f"{fields['warc-record-id']}: it revisits another payload")
    else:
        raise BadArchive(f"record type {kind!r}")
    url = fields["warc-target-uri"]
    return {
        "page_id": page,
        "url": None if url == fields["warc-record-id"][1:-1] else unquote(url),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": refers_to,
        "payload": payload,
    }


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from its header and block headers."""
    head = bytes(data[at : at + 18])
    parameters = zstandard.get_frame_parameters(head)
    at += zstandard.frame_header_size(head)
    last = False
    while not last:
        if at + 3 > len(data):
            raise BadArchive("a frame is cut short")
        block = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    at += 4 * parameters.has_checksum
    if at > len(data):
        raise BadArchive("a frame is cut short")
    return at


def read_archive(content: bytes) -> Iterator[dict]:
    """The records of one archive, one at a time."""
    data, at = memoryview(content), 0
    decoder = zstandard.ZstdDecompressor()
    while at < len(data):
        if at + 8 > len(data):
            raise BadArchive("bytes are left over")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            if magic == DICTIONARY_MAGIC:
                if at:
                    raise BadArchive("a dictionary does not come first")
                words = bytes(data[8 : 8 + size])
                if words[:4] == struct.pack("<I", FRAME_MAGIC):
                    words = zstandard.ZstdDecompressor().decompress(words, max_output_size=MAX_RECORD_BYTES)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
            at += 8 + size
            if at > len(data):
                raise BadArchive("a skippable frame is cut short")
            continue
        if magic != FRAME_MAGIC:
            raise BadArchive(f"no frame begins at byte {at}")
        end = frame_end(data, at)
        yield parse_record(decoder.decompress(data[at:end], max_output_size=MAX_RECORD_BYTES))
        at = end


def train_dictionary(pages: DataFrame, page: str = "page_id", html: str = "html") -> bytes:
    """A dictionary from a bounded sample of pages; empty where too few are there."""
    rows = pages.count()
    body = F.substring(F.col(f"`{html}`").cast("binary"), 1, TRAIN_BYTES)
    heads = pages.where(F.col(f"`{html}`").isNotNull()).select(F.col(f"`{page}`").alias("page"), body.alias("b"))
    found = bounded(heads, rows, TRAIN_PAGES, "page", "b").select("b").collect()
    samples = sorted(bytes(r.b) for r in found)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", html: str = "html", revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write a record per row into archives under ``path``."""
    payload = F.coalesce(F.col(f"`{html}`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{page}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest")
    ).withColumn("size", F.octet_length("payload").cast("long"))
    last = rows.where(F.col("size") >= revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("last"))
    # pages of the same payload are told apart from the one they revisit, whose id is the largest
    joined = rows.join(last, "digest", "left").withColumn(
        "refers_to", F.when(F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("page_id")), F.col("last"))
    )
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b""))
    plan = joined.select("page_id", "url", body.alias("payload"), "digest", "size", "refers_to")
    dictionary = train_dictionary(pages, page, html)
    schema = T.StructType([T.StructField("frame", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=given, write_checksum=True, write_content_size=True)
        begun = not dictionary
        for batch in batches:
            for at in range(0, len(batch), 256):
                columns = [c.to_pylist() for c in batch.slice(at, 256).columns]
                frames = [coder.compress(build_record(p, u, b, d, n, r)) for p, u, b, d, n, r in zip(*columns)]
                if not begun and frames:
                    frames.insert(0, dictionary_frame(dictionary))
                    begun = True
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

    plan.mapInArrow(run, schema).select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).option("compression", "none").text(path)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under ``path``; a broken archive stops the job."""
    schema = RECORD if payloads else T.StructType(RECORD.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held: list[dict] = []
                size = 0
                for record in read_archive(content.as_py()):
                    size += len(record["payload"] or b"")
                    if not payloads:
                        del record["payload"]
                    held.append(record)
                    if len(held) >= 1000 or payloads and size > 1 << 22:
                        yield _batch(held, schema)
                        held, size = [], 0
                yield _batch(held, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def _batch(records: list[dict], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], kinds.get(n, pa.string())) for n in schema.names], schema.names)


def archived(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", payloads: bool = False) -> DataFrame:
    """Pages written to archives in shared storage and read back from them."""
    path = new_folder(pages.sparkSession, "archives")
    write_archives(pages, path, page, url, html)
    return read_archives(pages.sparkSession, path, payloads)
