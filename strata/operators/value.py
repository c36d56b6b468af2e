"""Tax and property value by year and place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.functions import sqltext
from strata.functions.scalars import measure, quoted
from strata.operators import partials
from strata.operators.counting import top_k
from strata.operators.percentiles import exact_medians, exact_percentiles, finished, sketched
from strata.operators.small_side import null_safe_join
from strata.spec import ROLES, Roles

_STATS = ["ano", "media", "mediana", "minimo", "maximo", "total", "count", "count_nonzero"]


def _yearly_values(df: DataFrame, roles: Roles, name: str) -> DataFrame:
    return df.select(quoted(roles.year).alias("ano"), measure(df, name).alias("valor"))


def _with_population(valid: DataFrame) -> DataFrame:
    """``counted``: the taxes above zero, or all of them where no year has any.

    Whether there are any is a scalar subquery of the plan, not a job of its own.
    """
    some = valid.agg(F.bool_or(F.col("valor") > 0).alias("any_tax")).scalar()
    marked = valid.withColumn("any_tax", F.coalesce(some, F.lit(False)))
    return marked.selectExpr("ano", "valor", "CASE WHEN valor > 0 OR NOT any_tax THEN valor END AS counted")


def _with_median(
    rows: DataFrame, population: str, aggregates: dict[str, str], approximate: bool
) -> DataFrame:
    """The aggregates and the median of ``population`` per year, all as SQL."""
    if approximate:
        return _approximate(rows, population, aggregates)
    return exact_percentiles(rows, ["ano"], F.expr(population), [0.5], ["mediana"], aggregates)


def _approximate(rows: DataFrame, population: str, aggregates: dict[str, str]) -> DataFrame:
    median = {"mediana": f"percentile_approx({population}, 0.5)"}
    return rows.groupBy("ano").agg(*[sqltext.expr(sql, name) for name, sql in (aggregates | median).items()])


def _taxes_counted(rows: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """Aggregates and median of the taxes above zero, or of all where no year has any.

    The yearly counts of the first pass tell which, so the table is not read to find out.
    """
    for population in ("CASE WHEN valor > 0 THEN valor END", "valor"):
        chosen = {name: sql.replace("counted", population) for name, sql in aggregates.items()}
        found, years = sketched(rows, ["ano"], F.expr(population), [0.5], chosen)
        if not years.where("count_nonzero > 0").isEmpty():
            break
    return finished(found, years, ["ano"], [0.5], ["mediana"], chosen)


def tax_stats_by_year(
    df: DataFrame, roles: Roles = ROLES, fill_zero: bool = False, approximate: bool = False
) -> DataFrame:
    """Mean, median, min and max of the taxes above zero; total and counts of all.

    One aggregation serves both populations. A year of zeros has NULL
    statistics (0 with ``fill_zero``). Where no year has any tax above zero,
    the statistics are of all readable taxes.
    """
    valid = _yearly_values(df, roles, roles.tax_value).where("valor IS NOT NULL")
    aggregates = {
        "media": "avg(counted)",
        "minimo": "min(counted)",
        "maximo": "max(counted)",
        "total": "sum(valor)",
        "count": "count(1)",
        "count_nonzero": "count_if(valor > 0)",
    }
    if approximate:
        stats = _approximate(_with_population(valid), "counted", aggregates)
    else:
        stats = _taxes_counted(valid, aggregates)
    stats = stats.select(*_STATS)
    if fill_zero:
        stats = stats.fillna(0.0, ["media", "mediana", "minimo", "maximo"])
    return stats.orderBy("ano")


def tax_stats_by_year_joined(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """The same result as two aggregations put together by a full outer join."""
    valid = _with_population(_yearly_values(df, roles, roles.tax_value).where(F.col("valor").isNotNull()))
    positive = valid.where(F.col("counted").isNotNull())
    stats = positive.groupBy("ano").agg(
        F.avg("valor").alias("media"),
        F.min("valor").alias("minimo"),
        F.max("valor").alias("maximo"),
    )
    totals = valid.groupBy("ano").agg(
        F.sum("valor").alias("total"),
        F.count(F.lit(1)).alias("count"),
        F.count_if(F.col("valor") > 0).alias("count_nonzero"),
    )
    medians = exact_medians(positive, ["ano"], F.col("valor"), "mediana")
    # the taxes counted are some of all, so no year is on the right side only
    joined = null_safe_join(null_safe_join(totals, stats, ["ano"], "left"), medians, ["ano"], "left")
    return joined.select(*_STATS)


def avg_tax_by_neighborhood_top(df: DataFrame, roles: Roles = ROLES, k: int = 20) -> DataFrame:
    """Places with the greatest mean tax, zeros included. ``df`` may hold partial states of the taxes."""
    outputs = {"media": ("avg", roles.tax_value), "total": ("sum", roles.tax_value), "count": ("count", roles.tax_value)}
    means = partials.summary(df, [roles.neighborhood], outputs).where("count > 0")
    named = means.select(quoted(roles.neighborhood).alias("bairro"), *outputs)
    return top_k(named, "media", k, ["bairro"])


def property_value_by_year(
    df: DataFrame, roles: Roles = ROLES, approximate: bool = False
) -> DataFrame:
    """Property value by year; ``count`` counts rows, readable value or not."""
    values = _yearly_values(df, roles, roles.property_value)
    aggregates = {"media": "avg(valor)", "total": "sum(valor)", "count": "count(1)"}
    stats = _with_median(values, "valor", aggregates, approximate)
    return stats.select("ano", "media", "mediana", "total", "count").orderBy("ano")
