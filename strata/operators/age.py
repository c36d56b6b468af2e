"""Construction age: its distribution, statistics and relation to tax.

The reference year is a parameter; the calendar would make results depend on
the day they are computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.functions.scalars import (
    age_band,
    age_band_ordinal,
    age_in_years,
    is_valid_built_year,
    measure,
    whole_number,
)
from strata.operators.counting import count_by, with_share
from strata.spec import AGE_BANDS_6, AGE_BANDS_7, ROLES, Roles


def with_age(df: DataFrame, reference_year: int, roles: Roles = ROLES) -> DataFrame:
    """Add ``ano_construcao`` and ``idade_construcao``; keep rows built in a valid year."""
    built = whole_number(df, roles.built_year)
    return df.where(is_valid_built_year(built, reference_year)).withColumns(
        {"ano_construcao": built, "idade_construcao": age_in_years(built, reference_year)}
    )


def age_distribution(
    df: DataFrame, reference_year: int, roles: Roles = ROLES, right_closed: bool = True
) -> DataFrame:
    """Rows and share per age band, with the band's place in age order."""
    aged = with_age(df, reference_year, roles)
    band = age_band(F.col("idade_construcao"), AGE_BANDS_7, right_closed)
    banded = aged.withColumn("faixa_idade", band)
    counts = count_by(banded, {"faixa_idade": "faixa_idade"}, "quantidade")
    return (
        with_share(counts, "quantidade")
        .withColumn("ordem", age_band_ordinal(F.col("faixa_idade"), AGE_BANDS_7))
        .orderBy(F.desc("quantidade"), "faixa_idade")
    )


def age_statistics(df: DataFrame, reference_year: int, roles: Roles = ROLES) -> DataFrame:
    """Mean, median, least and greatest age.

    Valid ages are whole numbers from 0 to the reference year, so rows are
    first counted per age; the exact median then sees a table of bounded size.
    """
    aged = with_age(df, reference_year, roles)
    per_age = count_by(aged, {"idade_construcao": "idade_construcao"}, "n")
    age, n = F.col("idade_construcao"), F.col("n")
    return per_age.agg(
        F.try_divide(F.sum(age * n), F.sum(n)).cast("double").alias("media"),
        F.percentile(age, 0.5, n).alias("mediana"),
        F.min(age).alias("minimo"),
        F.max(age).alias("maximo"),
    )


def age_statistics_long(df: DataFrame, reference_year: int, roles: Roles = ROLES) -> DataFrame:
    """The same statistics as (metrica, valor) rows."""
    names = ["media", "mediana", "minimo", "maximo"]
    wide = age_statistics(df, reference_year, roles)
    wide = wide.select(*[F.col(name).cast("double").alias(name) for name in names])
    return wide.unpivot([], names, "metrica", "valor")


def age_value_relationship(
    df: DataFrame, reference_year: int, roles: Roles = ROLES, right_closed: bool = True
) -> DataFrame:
    """Mean of the taxes above zero per age band."""
    aged = with_age(df, reference_year, roles)
    tax = measure(aged, roles.tax_value)
    band = age_band(F.col("idade_construcao"), AGE_BANDS_6, right_closed)
    taxed = aged.select(band.alias("faixa_idade"), tax.alias("valor")).where(F.col("valor") > 0)
    means = taxed.groupBy("faixa_idade").agg(
        F.avg("valor").alias("valor_medio"), F.count(F.lit(1)).alias("quantidade")
    )
    return means.withColumn("ordem", age_band_ordinal(F.col("faixa_idade"), AGE_BANDS_6)).orderBy("ordem")
