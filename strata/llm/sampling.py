"""Bounded samples to learn from, and the fold of rows that is never learnt from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

_PARTS = 1 << 20


def held_out(key: str = "doc_id") -> Column:
    """Rows whose key's checksum leaves 2 when divided by 4; a NULL key is not held out."""
    checksum = F.crc32(F.col(f"`{key}`").cast("string").cast("binary"))
    return F.coalesce(F.pmod(checksum, F.lit(4)) == 2, F.lit(False))


def bounded(df: DataFrame, rows: int, bound: int, *columns: str) -> DataFrame:
    """At most ``bound`` different rows of the columns: those whose hash is least.

    ``rows`` is about the table's number of rows. Rows are chosen by all columns and repeated ones count once, so
    neither a hot key nor NULL keys bring in more.
    """
    key = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    share = min(_PARTS, 2 * _PARTS * bound // max(rows, 1) + 16)
    some = df.select(*[F.col(f"`{c}`") for c in columns]).where(F.pmod(key, F.lit(_PARTS)) < share).distinct()
    return some.orderBy(key, *[F.col(f"`{c}`") for c in columns]).limit(bound)


def bounded_by_label(df: DataFrame, label: str, counts: dict[str, int], bound: int, *columns: str) -> DataFrame:
    """At most ``bound`` different rows of each label, chosen as ``bounded`` does. ``counts`` has each label's rows."""
    columns = (label, *columns)
    key = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    wanted = F.lit(False)
    for value, rows in counts.items():
        share = min(_PARTS, 2 * _PARTS * bound // max(rows, 1) + 16)
        wanted = wanted | ((F.col(f"`{label}`") == value) & (F.pmod(key, F.lit(_PARTS)) < share))
    some = df.select(*[F.col(f"`{c}`") for c in columns]).where(wanted).distinct()
    order = Window.partitionBy(f"`{label}`").orderBy(key, *[F.col(f"`{c}`") for c in columns])
    return some.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= bound).drop("__n")


def learnable(df: DataFrame, key: str) -> DataFrame:
    return df.where(~held_out(key) & F.col(f"`{key}`").isNotNull())
