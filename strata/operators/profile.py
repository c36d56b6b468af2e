"""Column profiles. Each reads the table once, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    FloatType,
    MapType,
    NumericType,
    StringType,
    StructType,
)

from strata.functions import sqltext
from strata.functions.scalars import quoted, share_pct
from strata.operators.counting import top_k_per_group
from strata.operators.percentiles import percentiles_of_columns
from strata.operators.small_side import null_safe_join
from strata.spec import Thresholds


def columns_of(df: DataFrame, *kinds: type[DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def missing_sql(df: DataFrame, name: str) -> str:
    """Whether a cell is NULL, or NaN where its type has one."""
    value = sqltext.name(name)
    if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        return f"({value} IS NULL OR isnan({value}))"
    return f"{value} IS NULL"


def per_column(
    df: DataFrame, metrics: dict[str, dict[str, str]], by: Sequence[str] = ()
) -> DataFrame:
    """One aggregation over all columns, turned into one row per column.

    ``metrics`` maps column name to its named aggregates, as SQL. Output: the
    ``by`` keys, ``column``, ``rows`` and the aggregates.
    """
    cells = ", ".join(
        f"struct({sqltext.text(name)} AS column, "
        + ", ".join(f"{sql} AS {sqltext.name(metric)}" for metric, sql in named.items())
        + ")"
        for name, named in metrics.items()
    )
    keys = [quoted(b) for b in by]
    wide = df.groupBy(*keys).agg(F.expr("count(1) AS rows"), F.expr(f"array({cells}) AS __cells"))
    return wide.select(*keys, "rows", F.inline("__cells"))


def null_profile(
    df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Missing cells per column: count and percent of rows."""
    names = list(columns or [c for c in df.columns if c not in by])
    counted = per_column(
        df, {c: {"null_count": f"count_if({missing_sql(df, c)})"} for c in names}, by
    )
    return counted.withColumn("null_pct", share_pct(F.col("null_count"), F.col("rows")))


def high_null_columns(
    df: DataFrame, max_null_pct: float = Thresholds.max_null_pct, by: Sequence[str] = ()
) -> DataFrame:
    profile = null_profile(df, by=by)
    return profile.where(F.col("null_count") * 100.0 / F.col("rows") > max_null_pct)


def empty_string_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Text columns holding empty strings, most first."""
    names = [c for c in columns_of(df, StringType) if c not in by]
    counted = per_column(
        df, {c: {"empty_count": f"count_if({sqltext.name(c)} = '')"} for c in names}, by
    )
    found = counted.where(F.col("empty_count") > 0)
    share = share_pct(F.col("empty_count"), F.col("rows"))
    return found.withColumn("empty_pct", share).orderBy(F.desc("empty_count"), "column")


def _long(df: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """(column, value) rows; ``value`` is SQL text with ``{}`` for the column."""
    cells = ", ".join(
        f"struct({sqltext.text(c)} AS column, {value.format(sqltext.name(c))} AS value)"
        for c in columns
    )
    return df.selectExpr(f"inline(array({cells}))")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for every distinct value of every column, NULL aside.

    Values of all columns share one aggregation keyed by (column, value), so no
    column's values gather in one task, and repeated values combine map-side.
    """
    long = _long(df, columns, "CAST({} AS STRING)").where("value IS NOT NULL")
    return long.groupBy("column", "value").agg(F.expr("count(1) AS n"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, distinct_count), zero for a column without values."""
    counted = value_counts(df, columns).groupBy("column").agg(F.expr("count(1) AS distinct_count"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(counted, "column", "left").fillna(0, ["distinct_count"])


# Largest bound for which the sketch below settles which columns are wide.
MAX_SKETCHED_BOUND = 100


def low_cardinality(df: DataFrame, below: int = Thresholds.low_cardinality) -> DataFrame:
    """Text columns with fewer than ``below`` distinct values, counted over all rows.

    A first pass of fixed-size sketches rules out the wide columns, whose
    distinct values would otherwise all be shuffled; the rest are counted
    exactly. With so few values nearly all of the sketch's 512 registers stay
    empty, where its estimate exceeds the true count by a few percent at most,
    so a column estimated at twice the bound is certainly not a narrow one.
    """
    columns = columns_of(df, StringType)
    if below <= MAX_SKETCHED_BOUND and columns:
        sketches = [F.expr(f"approx_count_distinct({sqltext.name(c)}, 0.05)") for c in columns]
        estimates = df.agg(*sketches).first()
        columns = [c for c, estimate in zip(columns, estimates) if estimate < 2 * below]
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, distinct_count bigint")
    counts = distinct_counts(df, columns)
    return counts.where(F.col("distinct_count") < below)


def categorical_top_values(
    df: DataFrame, columns: Sequence[str] | None = None, few: int = 20, k_few: int = 10, k_many: int = 5
) -> DataFrame:
    """Most frequent values per text column: ``k_few`` when it has at most ``few``
    distinct values, else ``k_many``, with the distinct count."""
    counts = value_counts(df, columns or columns_of(df, StringType))
    distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("distinct_count"))
    # The literal bound first: each task then sends at most that many rows per column.
    widest = top_k_per_group(counts, ["column"], "n", max(k_few, k_many), ["value"])
    few_rows = widest.groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("order"), "value", "n"))).alias("top")
    )
    allowed = F.when(F.col("distinct_count") <= few, k_few).otherwise(k_many)
    kept = few_rows.join(distinct, "column").select(
        "column", "distinct_count", F.posexplode(F.slice("top", F.lit(1), allowed))
    )
    return kept.select(
        "column",
        "distinct_count",
        (F.col("pos") + 1).alias("rank"),
        F.col("col.value").alias("value"),
        F.col("col.n").alias("n"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, stddev, min, quartiles and max per numeric column.

    All columns share the same passes, in which a row of the table stays one row.
    """
    names = list(columns or columns_of(df, NumericType))
    values = {name: f"nullif(CAST({sqltext.name(name)} AS DOUBLE), double('NaN'))" for name in names}
    moments = {
        "count": "count(__v)",
        "mean": "avg(__v)",
        "std": "stddev(__v)",
        "min": "min(__v)",
        "max": "max(__v)",
    }
    summary = percentiles_of_columns(df, values, [0.25, 0.5, 0.75], ["p25", "p50", "p75"], moments)
    return summary.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def id_candidates(df: DataFrame, token: str = "id") -> DataFrame:
    """Columns whose name contains ``token``: distinct values against rows."""
    names = [c for c in df.columns if token in c.lower()]
    rows = df.agg(F.count(F.lit(1))).scalar()
    return distinct_counts(df, names).withColumn("rows", rows)


def row_hashes(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Three 64-bit hashes of the columns' values, NULLs and their places included."""
    parts: list[Column] = []
    for name in columns:
        kind = df.schema[name].dataType
        nested = isinstance(kind, (ArrayType, MapType, StructType))
        # a hash skips NULLs inside nested values; their text shows them
        value = F.to_json(F.struct(quoted(name)), {"ignoreNullFields": "false"}) if nested else quoted(name)
        parts += [quoted(name).isNull(), value]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"__h{seed}") for seed in (1, 2, 3)]


def row_copies(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``__n``, the number of its copies, for every different row, with the ``by`` columns.

    Rows are shuffled as two hashes. Where a third one tells rows of equal hashes apart, those rows, and no
    others, are compared by their values.
    """
    hashed = df.select(*[quoted(c) for c in by], *row_hashes(df, columns))
    groups = hashed.groupBy(*[quoted(c) for c in by], "__h1", "__h2").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__h3").alias("__lo"), F.max("__h3").alias("__hi")
    )
    alike = groups.where("__lo = __hi").select(*[quoted(c) for c in by], "__n")
    keys = [*by, "__h1", "__h2"]
    torn = groups.where("__lo != __hi").select(*[quoted(c).alias(f"__torn_{i}") for i, c in enumerate(keys)])
    same = [quoted(c).eqNullSafe(F.col(f"__torn_{i}")) for i, c in enumerate(keys)]
    whole = df.select("*", *row_hashes(df, columns)).join(torn, same, "left_semi")
    compared = whole.groupBy(*[quoted(c) for c in dict.fromkeys([*by, *columns])]).agg(F.count(F.lit(1)).alias("__n"))
    return alike.unionByName(compared.select(*[quoted(c) for c in by], "__n"))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Repeated full rows: groups of copies, and rows beyond the first of each.

    Copies combine map-side, so a row repeated in a third of the table reaches
    its reducer once per map task, as two hashes and a count.
    """
    return row_copies(df, columns or df.columns).agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count_if(F.col("__n") > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("excess_rows"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and their number as percent of all rows."""
    counted = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    totals = counted.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count_if(F.col("__n") > 1).alias("duplicate_keys"),
    )
    share = F.coalesce(share_pct(F.col("duplicate_keys"), F.col("rows")), F.lit(0.0))
    return totals.withColumn("duplicate_pct", share)


def dataset_overview(df: DataFrame, by: str) -> DataFrame:
    """Rows, missing cells and surplus copies per value of ``by``."""
    missing = [f"CAST({missing_sql(df, c)} AS BIGINT)" for c in df.columns if c != by]
    cells = f"sum({' + '.join(missing)})" if missing else "0L"
    sizes = df.groupBy(quoted(by)).agg(
        F.expr("count(1) AS rows"), F.expr(f"{cells} AS missing_cells")
    )
    copies = row_copies(df, df.columns, [by])
    surplus = copies.groupBy(quoted(by)).agg(F.sum(F.col("__n") - 1).alias("duplicate_rows"))
    return null_safe_join(sizes, surplus, [by], "inner")


def presence_matrix(rows: DataFrame, group: str, name: str, groups: Sequence) -> DataFrame:
    """For (group, name) rows: one boolean ``In_<group>`` per group and name.

    The rows may be the header names of yearly files or values in the data.
    """
    flags = [
        F.coalesce(F.bool_or(quoted(group) == g), F.lit(False)).alias(f"In_{g}") for g in groups
    ]
    return rows.groupBy(quoted(name)).agg(*flags)


def presence_differences(
    rows: DataFrame, group: str, name: str, groups: Sequence
) -> DataFrame:
    """(group, name, only_in) wherever a later group differs from the first."""
    base, later = groups[0], list(groups[1:])
    matrix = presence_matrix(rows, group, name, groups)
    in_base = quoted(f"In_{base}")
    cells = F.array(
        *[F.struct(F.lit(g).alias(group), quoted(f"In_{g}").alias("__here")) for g in later]
    )
    compared = matrix.select(quoted(name), in_base.alias("__base"), F.inline(cells))
    differing = compared.where(F.col("__base") != F.col("__here"))
    only_in = F.when(F.col("__base"), F.lit(str(base))).otherwise(quoted(group).cast("string"))
    return differing.select(quoted(group), quoted(name), only_in.alias("only_in"))
