"""Growth of each neighbourhood between the first and last year of a window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.scalars import growth_pct, measure, quoted
from strata.operators import partials
from strata.operators.counting import top_k
from strata.spec import ROLES, Roles, Thresholds

# The window of fiscal years compared by default.
FIRST_YEAR = 2020
LAST_YEAR = 2023

_COLUMNS = [
    "bairro",
    "quantidade_inicial",
    "valor_medio_inicial",
    "quantidade_final",
    "valor_medio_final",
    "crescimento_quantidade",
    "crescimento_valor",
]


def _taxed_by_place_and_year(
    df: DataFrame, roles: Roles, first_year: int, last_year: int
) -> DataFrame:
    """Sum and count of the taxes above zero per place and year of the window.

    ``df`` may hold partial states; they must be of taxes above zero only.
    """
    tax = roles.tax_value
    window = df.where(quoted(roles.year).between(first_year, last_year))
    if not partials.is_states(df, tax):
        rows = window.select(quoted(roles.neighborhood), quoted(roles.year), measure(df, tax).alias(tax))
        window = rows.where(quoted(tax) > 0)
    found = partials.summary(window, [roles.neighborhood, roles.year], {"quantidade": ("count", tax), "valor_medio": ("avg", tax)})
    return found.select(quoted(roles.neighborhood).alias("bairro"), quoted(roles.year).alias("ano"), "quantidade", "valor_medio")


def _end_years(stats: DataFrame) -> tuple[Column, Column]:
    """First and last year present, as scalar subqueries over the grouped rows."""
    return stats.agg(F.min("ano")).scalar(), stats.agg(F.max("ano")).scalar()


def neighborhood_evolution(
    df: DataFrame,
    roles: Roles = ROLES,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    min_support: int = Thresholds.min_support,
) -> DataFrame:
    """Count and mean tax in the window's end years, and their growth in percent.

    Kept are places present in both end years with more than ``min_support``
    rows in the first; empty when the window holds fewer than two years. The
    end years are picked by conditional aggregation: one scan, no self-join.
    """
    stats = _taxed_by_place_and_year(df, roles, first_year, last_year)
    first, last = _end_years(stats)
    year = F.col("ano")
    ends = stats.where((year == first) | (year == last)).withColumns(
        {"primeiro": year == first, "ultimo": (year == last) & (year != first)}
    )
    per_place = ends.groupBy("bairro").agg(
        F.max(F.when(F.col("primeiro"), F.col("quantidade"))).alias("quantidade_inicial"),
        F.max(F.when(F.col("primeiro"), F.col("valor_medio"))).alias("valor_medio_inicial"),
        F.max(F.when(F.col("ultimo"), F.col("quantidade"))).alias("quantidade_final"),
        F.max(F.when(F.col("ultimo"), F.col("valor_medio"))).alias("valor_medio_final"),
    )
    known = per_place.where(
        F.col("bairro").isNotNull()
        & F.col("quantidade_final").isNotNull()
        & (F.col("quantidade_inicial") > min_support)
    )
    return _with_growth(known)


def neighborhood_evolution_joined(
    df: DataFrame,
    roles: Roles = ROLES,
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
    min_support: int = Thresholds.min_support,
) -> DataFrame:
    """The same result as an inner join of the two end years' statistics."""
    stats = _taxed_by_place_and_year(df, roles, first_year, last_year)
    first, last = _end_years(stats)
    year = F.col("ano")
    initial = stats.where((year == first) & (first < last)).select(
        "bairro",
        F.col("quantidade").alias("quantidade_inicial"),
        F.col("valor_medio").alias("valor_medio_inicial"),
    )
    final = stats.where(year == last).select(
        "bairro",
        F.col("quantidade").alias("quantidade_final"),
        F.col("valor_medio").alias("valor_medio_final"),
    )
    both = initial.join(final, "bairro", "inner")
    return _with_growth(both.where(F.col("quantidade_inicial") > min_support))


def _with_growth(ends: DataFrame) -> DataFrame:
    count_growth = growth_pct(F.col("quantidade_inicial"), F.col("quantidade_final"))
    value_growth = growth_pct(F.col("valor_medio_inicial"), F.col("valor_medio_final"))
    grown = ends.withColumns(
        {"crescimento_quantidade": count_growth, "crescimento_valor": value_growth}
    )
    return grown.select(*_COLUMNS).orderBy(F.desc("crescimento_quantidade"), "bairro")


def top_growth_quantity(evolution: DataFrame, k: int = 20) -> DataFrame:
    return top_k(evolution, "crescimento_quantidade", k, ["bairro"])


def top_growth_value(evolution: DataFrame, k: int = 20) -> DataFrame:
    return top_k(evolution, "crescimento_valor", k, ["bairro"])


def growth_positive_or_worst(
    evolution: DataFrame, by: str = "crescimento_quantidade", k: int = 15
) -> DataFrame:
    """Top k growing places; where none grows, the k with the smallest values.

    Which case holds is a scalar subquery over the small evolution table, so
    the choice is part of the plan.
    """
    growth = quoted(by)
    any_growth = F.coalesce(evolution.agg(F.max(growth)).scalar() > 0, F.lit(False))
    kept = evolution.where(F.when(any_growth, growth > 0).otherwise(growth.isNotNull()))
    order = F.when(any_growth, -growth).otherwise(growth)
    return kept.orderBy(order, "bairro").limit(k)
