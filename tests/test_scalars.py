from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import scalars
from strata.spec import AGE_BANDS_6, AGE_BANDS_7


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_currency_text(spark):
    texts = ["R$ 1234,56", "R$ 1,5", " 1.5 ", "R$", "abc", None, "0", "NaN", "-3,25"]
    df = one_column(spark, texts)
    assert apply(df, scalars.parse_currency("v")) == [
        1234.56, 1.5, 1.5, None, None, None, 0.0, None, -3.25,
    ]


def test_currency_passes_numbers_through(spark):
    df = one_column(spark, [1.5, None, 0.0, 1e9], "double")
    assert apply(df, scalars.parse_currency("v")) == [1.5, None, 0.0, 1e9]
    assert apply(df, scalars.measure(df, "v")) == [1.5, None, 0.0, 1e9]


def test_measure_treats_nan_as_missing(spark):
    df = one_column(spark, [float("nan"), 2.0], "double")
    assert apply(df, scalars.measure(df, "v")) == [None, 2.0]


def test_lenient_numbers(spark):
    df = one_column(spark, ["12", "12.5", "S/N", None, "", "1985.0"])
    assert apply(df, scalars.lenient_double("v")) == [12.0, 12.5, None, None, None, 1985.0]
    assert apply(df, scalars.lenient_int("v")) == [12, 12, None, None, None, 1985]


def test_registration_date(spark):
    texts = [
        "2020/1/5 00:00:00.000000000", "2020/12/31 23:59:59", "2021-03-04", "2021-03-04 10:11:12",
        "lixo", None,
    ]
    assert apply(one_column(spark, texts), scalars.parse_registration_date("v")) == [
        dt.date(2020, 1, 5), dt.date(2020, 12, 31), dt.date(2021, 3, 4), dt.date(2021, 3, 4),
        None, None,
    ]


def test_postal_code(spark):
    df = one_column(spark, ["50000001", "5000", "abc", None, "123456789", " 1234567 "])
    padded = df.withColumn("v", scalars.postal_code("v"))
    assert apply(padded, F.col("v")) == [
        "50000001", "00005000", "abc", None, "123456789", "01234567",
    ]
    assert apply(padded, scalars.is_postal_code_ok("v")) == [True, True, False, True, False, True]


@pytest.mark.parametrize("closed,expected", [
    (True, ["0-10", "0-10", "11-20", "11-20", "21-30", "31-40", "41-50", "51-60", "60+"]),
    (False, ["0-10", "11-20", "11-20", "21-30", "31-40", "41-50", "51-60", "60+", "60+"]),
])
def test_age_band_edges(spark, closed, expected):
    df = one_column(spark, [0, 10, 11, 20, 30, 40, 50, 60, 61], "int")
    band = scalars.age_band(F.col("v"), AGE_BANDS_7, closed)
    assert apply(df, band) == [label + " anos" for label in expected]


def test_age_band6_and_order(spark):
    df = one_column(spark, [5, 10, 50, 51, 99], "int")
    band = scalars.age_band(F.col("v"), AGE_BANDS_6)
    assert apply(df, band) == ["0-10", "0-10", "41-50", "50+", "50+"]
    assert apply(df, scalars.age_band_ordinal(band, AGE_BANDS_6)) == [1, 1, 5, 6, 6]


def test_growth_and_share_survive_zero(spark):
    df = spark.createDataFrame([(0, 0.0, 5.0), (1, 4.0, 5.0)], "i int, a double, b double")
    assert apply(df, scalars.growth_pct(F.col("a"), F.col("b"))) == [None, 25.0]
    assert apply(df, scalars.share_pct(F.col("b"), F.col("a"))) == [None, 125.0]


def test_year_in_name(spark):
    names = ["a_2023_2021.csv", "dados.csv", "x2019.csv", "2030.csv"]
    df = one_column(spark, names)
    path = F.concat(F.lit("/raw/iptu_2022/"), F.col("v"))
    assert apply(df, scalars.year_in_name(path, F.col("v"))) == [2021, 2022, 2019, 2030]
