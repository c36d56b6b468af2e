"""Tables shaped for charts and reports; drawing them is not this library's work."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.scalars import measure, quoted
from strata.operators import volume
from strata.operators.counting import top_k
from strata.operators.percentiles import exact_percentiles
from strata.operators.small_side import compute_once, null_safe_join
from strata.spec import ROLES, Roles


def pivot_map(df: DataFrame, index: str, columns: str, values: str) -> DataFrame:
    """Rows by ``index`` with ``cells``, a map of heading to value: any number of headings in one plan."""
    sums = df.groupBy(quoted(index), quoted(columns)).agg(F.sum(quoted(values)).alias("__n"))
    entry = F.when(quoted(columns).isNotNull(), F.struct(quoted(columns).alias("key"), F.col("__n").alias("value")))
    return sums.groupBy(quoted(index)).agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))


def pivot_filled(
    df: DataFrame, index: str, columns: str, values: str, headings: Sequence | None = None,
    first: int | None = None,
) -> DataFrame:
    """Rows by ``index``, one column per heading, absent cells 0.

    Columns have to be named, so without ``headings`` they are read from ``df``, all of them in sort
    order (``first`` keeps only that many); ``df`` is a table of counts, computed once for both. The cells
    of a row come from one map, whatever the number of headings.
    """
    df = compute_once(df)
    if headings is None:
        found = df.select(columns).where(quoted(columns).isNotNull()).distinct().orderBy(columns)
        headings = [row[0] for row in (found if first is None else found.limit(first)).collect()]
    kind = df.schema[columns].dataType
    cells = [
        F.coalesce(F.try_element_at("cells", F.lit(h).cast(kind)), F.lit(0)).alias(str(h)) for h in headings
    ]
    return pivot_map(df, index, columns, values).select(quoted(index), *cells)


def pivot_year_type(df: DataFrame, roles: Roles = ROLES, first: int | None = None) -> DataFrame:
    """Volume by year with one column per use type; ``first`` keeps that many, by name."""
    counts = volume.volume_by_year_type(df, roles)
    return pivot_filled(counts, "ano", "tipo_uso", "total_imoveis", first=first)


def pivot_top_types(df: DataFrame, roles: Roles = ROLES, k: int = 5) -> DataFrame:
    """Volume by year with one column for each of the k most frequent use types."""
    counts = compute_once(volume.volume_by_year_type(df, roles))
    totals = counts.groupBy("tipo_uso").agg(F.sum("total_imoveis").alias("total"))
    leading = top_k(totals.where(F.col("tipo_uso").isNotNull()), "total", k, ["tipo_uso"])
    headings = [row["tipo_uso"] for row in leading.collect()]
    return pivot_filled(counts, "ano", "tipo_uso", "total_imoveis", headings)


def neighborhood_heatmap(df: DataFrame, roles: Roles = ROLES, k: int = 10) -> DataFrame:
    """Top neighbourhoods of each year, one column per year."""
    top = volume.top_neighborhoods_by_year(df, roles, k)
    return pivot_filled(top, "bairro", "ano", "quantidade")


def within_fences(
    df: DataFrame, group: str, amount: Column, spread: float = 3.0
) -> DataFrame:
    """Rows whose amount lies within ``spread`` interquartile ranges of the quartiles.

    The fences are exact and per group; ``fence_low`` and ``fence_high`` are added.
    """
    quartiles = exact_percentiles(df, [group], amount, [0.25, 0.75], ["__q1", "__q3"])
    reach = (F.col("__q3") - F.col("__q1")) * spread
    fences = quartiles.select(
        quoted(group),
        (F.col("__q1") - reach).alias("fence_low"),
        (F.col("__q3") + reach).alias("fence_high"),
    )
    fenced = null_safe_join(df, compute_once(fences), [group], "inner")
    return fenced.where(amount.between(F.col("fence_low"), F.col("fence_high")))


def _positive_taxes(df: DataFrame, roles: Roles) -> DataFrame:
    taxes = df.select(quoted(roles.year).alias("ano"), measure(df, roles.tax_value).alias("valor"))
    return taxes.where((F.col("valor") > 0) & F.col("ano").isNotNull())


def boxplot_by_year(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    """Box-plot figures per year of the taxes above zero and within the fences."""
    kept = within_fences(_positive_taxes(df, roles), "ano", F.col("valor"))
    marks = {"minimo": 0.0, "q1": 0.25, "mediana": 0.5, "q3": 0.75, "maximo": 1.0}
    return exact_percentiles(
        kept, ["ano"], F.col("valor"), list(marks.values()), list(marks), {"n": "count(1)"}
    )


def log_scale_flag(df: DataFrame, roles: Roles = ROLES, factor: float = 50.0) -> DataFrame:
    """Whether the greatest tax is more than ``factor`` times the median one."""
    taxes = _positive_taxes(df, roles)
    figures = exact_percentiles(
        taxes, [], F.col("valor"), [0.5], ["mediana"], {"maximo": "max(__v)"}
    )
    wide = F.coalesce(F.col("maximo") > F.col("mediana") * factor, F.lit(False))
    return figures.withColumn("use_log", wide)


def report_top(by_type: DataFrame, by_neighborhood: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent use types and neighbourhoods with their shares, from
    the volume outputs."""

    def section(counts: DataFrame, label: str) -> DataFrame:
        return top_k(counts, "total_imoveis", k, [label]).select(
            F.lit(label).alias("section"), quoted(label).alias("label"), "total_imoveis", "percentual"
        )

    return section(by_type, "tipo_uso").unionByName(section(by_neighborhood, "bairro"))


def summary_report_rows(
    total: DataFrame,
    by_year: DataFrame,
    by_type: DataFrame,
    by_neighborhood: DataFrame,
    tax_stats: DataFrame,
) -> DataFrame:
    """Lines of the text summary as (section, label, value, extra), from the
    outputs they quote.

    ``extra`` is the share for the top lists and the median for tax trends.
    """
    no_extra = F.lit(None).cast("double")

    def lines(
        rows: DataFrame, section: Column, label: Column, amount: str, extra: Column
    ) -> DataFrame:
        return rows.select(
            section.alias("section"),
            label.cast("string").alias("label"),
            quoted(amount).cast("double").alias("value"),
            extra.alias("extra"),
        )

    top = report_top(by_type, by_neighborhood)
    parts = [
        lines(total, F.lit("total"), F.lit("total"), "value", no_extra),
        lines(by_year, F.lit("ano"), F.col("ano"), "total_imoveis", no_extra),
        lines(top, F.col("section"), F.col("label"), "total_imoveis", F.col("percentual")),
        lines(tax_stats, F.lit("tendencia"), F.col("ano"), "media", F.col("mediana")),
    ]
    return reduce(DataFrame.unionByName, parts)
