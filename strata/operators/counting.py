"""Counts, shares and top-k: the shapes most named outputs are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.functions.scalars import quoted, share_pct


# A table that carries this column is counted already: each of its rows stands
# for that many records.
ROWS = "__rows"


def row_count(df: DataFrame) -> Column:
    """Number of records, whether ``df`` holds them one by one or counted."""
    if ROWS in df.columns:
        return F.coalesce(F.sum(ROWS), F.lit(0))
    return F.count(F.lit(1))


def counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records per combination of ``columns``: one scan that several counts can share."""
    return df.groupBy(*[quoted(c) for c in columns]).agg(row_count(df).alias(ROWS))


def count_by(
    df: DataFrame, keys: dict[str, str], name: str, drop_null_keys: bool = False
) -> DataFrame:
    """Records per group. ``keys`` maps output name to input column.

    A NULL key is a group of its own unless dropped. Spark counts map-side, so
    a hot key costs its reducer one row per map task.
    """
    grouped = df.groupBy(*[quoted(source).alias(out) for out, source in keys.items()])
    counts = grouped.agg(row_count(df).alias(name))
    return without_null_keys(counts, keys) if drop_null_keys else counts


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def total_of(counts: DataFrame, name: str) -> Column:
    """Grand total of a count column, as a scalar subquery.

    It reads the grouped rows, not the table: the aggregation's exchange is
    reused. (A window over everything would gather all groups in one task.)
    """
    return counts.agg(F.sum(quoted(name))).scalar()


def with_share(counts: DataFrame, name: str, share: str = "percentual") -> DataFrame:
    """Add each group's percentage of all rows, groups cut later included."""
    return counts.withColumn(share, share_pct(quoted(name), total_of(counts, name)))


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The k greatest rows; ties end in the order of ``tie_break``, NULLs last."""
    return df.orderBy(quoted(by).desc_nulls_last(), *[quoted(c).asc_nulls_last() for c in tie_break]).limit(k)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], by: str, k: int, tie_break: Sequence[str]
) -> DataFrame:
    """The k greatest rows of each group, all groups in one pass.

    With the literal bound Spark keeps k rows per group and task before the
    shuffle.
    """
    order = [quoted(by).desc_nulls_last(), *[quoted(c).asc_nulls_last() for c in tie_break]]
    window = Window.partitionBy(*[quoted(g) for g in group]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where(F.col("__rank") <= k).drop("__rank")
