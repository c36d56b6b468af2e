from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators import profile, quality
from strata.spec import ROLES as R, Domain, Spec
from tests.conftest import rows


def test_null_profile_counts_nan_for_floats_only(spark):
    df = spark.createDataFrame(
        [(1.0, True, [1], "a"), (float("nan"), None, None, ""), (None, False, [], None)],
        "f double, b boolean, a array<int>, s string",
    )
    assert rows(profile.null_profile(df), "column", "null_count", "null_pct") == [
        ("a", 1, 33.33), ("b", 1, 33.33), ("f", 2, 66.67), ("s", 1, 33.33),
    ]
    assert rows(profile.high_null_columns(df), "column") == [("f",)]
    assert rows(profile.empty_string_counts(df), "column", "empty_count", "empty_pct") == [("s", 1, 33.33)]


def test_null_profile_per_group(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, "y")], "g int, s string")
    assert rows(profile.null_profile(df, by=["g"]), "g", "rows", "column", "null_count") == [
        (1, 2, "s", 1), (2, 1, "s", 0),
    ]


def test_triple_row_is_two_excess_rows_in_one_group(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, None)] * 2 + [(3, "c")], "n int, s string")
    assert tuple(profile.duplicate_rows(df).first()) == (6, 2, 3)
    assert tuple(profile.duplicate_keys(df, ["n"]).first()) == (6, 2, 33.33)
    assert tuple(profile.duplicate_rows(df.limit(0)).first()) == (0, 0, 0)
    assert tuple(profile.duplicate_keys(df.limit(0), ["n"]).first()) == (0, 0, 0.0)


def test_low_cardinality_counts_all_rows_and_no_nulls(spark):
    df = spark.range(200).select(
        (F.col("id") % 49).cast("string").alias("few"),
        (F.col("id") % 50).cast("string").alias("many"),
        F.lit(None).cast("string").alias("none"),
    )
    assert rows(profile.low_cardinality(df)) == [("few", 49), ("none", 0)]
    assert rows(profile.low_cardinality(df, below=150)) == [("few", 49), ("many", 50), ("none", 0)]
    assert rows(profile.low_cardinality(df.select("many"))) == []


def test_no_narrow_column_is_ruled_out_by_its_sketch(spark):
    """Many columns of 99 distinct values each, none estimated at twice the bound."""
    df = spark.range(990).select(
        *[F.sha2(F.concat(F.lit(f"{i}:"), (F.col("id") % 99).cast("string")), 256).alias(f"c{i}")
          for i in range(60)]
    )
    got = profile.low_cardinality(df, below=100)
    assert {r["distinct_count"] for r in got.collect()} == {99} and got.count() == 60


def test_top_values_take_fewer_from_wide_columns(spark):
    df = spark.range(210).select(
        (F.col("id") % 21).cast("string").alias("wide"), (F.col("id") % 20).cast("string").alias("narrow")
    )
    got = profile.categorical_top_values(df)
    per_column = {r["column"]: r["count"] for r in got.groupBy("column").count().collect()}
    assert per_column == {"wide": 5, "narrow": 10}
    first = got.where("column = 'narrow' and rank <= 2").select("value", "n")
    assert rows(first) == [("0", 11), ("1", 11)]


def test_numeric_summary_matches_spark(spark):
    df = spark.range(101).select(F.col("id").alias("i"), (F.col("id") * 0.5).alias("d"), F.lit("x").alias("s"))
    got = {r["column"]: tuple(r)[1:] for r in profile.numeric_summary(df).collect()}
    assert set(got) == {"i", "d"}
    count, mean, std, low, p25, p50, p75, high = got["i"]
    assert (count, mean, low, p25, p50, p75, high) == (101, 50.0, 0.0, 25.0, 50.0, 75.0, 100.0)
    assert std == pytest.approx(df.agg(F.stddev("i")).first()[0])


def test_dataset_overview(spark):
    df = spark.createDataFrame(
        [(2020, "a", None), (2020, "a", None), (2021, None, None), (None, "b", 1.0)],
        "y int, s string, d double",
    )
    assert rows(profile.dataset_overview(df, "y")) == [
        (2020, 2, 2, 1), (2021, 1, 2, 0), (None, 1, 0, 0),
    ]


def test_presence_of_columns_across_years(spark):
    from strata.sources.manifest import header_rows

    headers = header_rows(spark, {2020: ["a", "b"], 2021: ["a", "c"], 2022: ["a", "b"]})
    years = [2020, 2021, 2022]
    assert rows(profile.presence_matrix(headers, "year", "column", years)) == [
        ("a", True, True, True), ("b", True, False, True), ("c", False, True, False),
    ]
    assert rows(profile.presence_differences(headers, "year", "column", years)) == [
        (2021, "b", "2020"), (2021, "c", "2021"),
    ]


def report_of(df):
    return {(r["scope"], r["check"]): (r["passed"], r["metric"]) for r in df.collect()}


def raw(spark, data, columns):
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def test_validate_raw(spark):
    columns = [R.year, R.postal_code, "cidade", "estado", "numero", "valor cobrado de IPTU", "novo"]
    data = [("2020", "50000001", "recife ", "PE", "12", "1", None)] * 98
    data += [("2021", "abc", "OLINDA", "PE", "S/N", "1", None)]
    report = quality.validate_raw(raw(spark, data, columns), 2020)
    got = report_of(report)
    assert got[("2020", "not_empty")] == (True, 99.0)
    assert got[("2020", "min_rows")] == (False, 99.0)
    assert got[("2020", "year_consistency")] == (False, 1.0)
    assert got[("2020", "numeric:CEP")] == (False, 1.0)
    assert got[("2020", "numeric:numero")] == (False, 1.0)
    assert got[("2020", "domain:cidade")] == (False, 1.0)
    assert got[("2020", "domain:estado")] == (True, 0.0)
    assert got[("2020", "nulls:novo")] == (False, 100.0)
    assert got[("2020", "renamed_columns")] == (False, 1.0)
    assert got[("2020", "extra_columns")] == (False, 2.0)
    assert not got[("2020", "required_columns")][0]


def test_expected_extra_column_is_not_reported(spark):
    df = raw(spark, [("1",)], ["_id"])
    extra = quality.check_columns(df, 2024).where("`check` = 'extra_columns'").first()
    assert extra["passed"]


def test_empty_file_fails(spark):
    df = raw(spark, [("2020",)], [R.year]).limit(0)
    got = report_of(quality.validate_raw(df, 2020))
    assert got[("2020", "not_empty")] == (False, 0.0)


def test_validate_silver_with_custom_rules(spark):
    df = spark.createDataFrame(
        [("1", 2020, "50000001", "RECIFE", "PE"), ("1", 2020, "5000000", "Recife ", "PE"),
         ("2", 2021, None, None, "SP")],
        f"`{R.entity}` string, `{R.year}` int, CEP string, cidade string, estado string",
    )
    custom = {
        "states": lambda d: F.count_distinct("estado"),
        "broken": lambda d: F.sum("missing"),
        "raises": lambda d: d["nope"],
    }
    report = quality.validate_silver(df, custom=custom)
    got = report_of(report)
    assert got[("all", "years_present")] == (True, 2.0)
    assert got[("all", "postal_code")] == (False, 1.0)
    assert got[("all", "domain:cidade")] == (True, 0.0)
    assert got[("all", "domain:estado")] == (False, 1.0)
    assert got[("all", "unique_keys")] == (False, 1.0)
    assert got[("all", "custom:states")] == (True, 2.0)
    assert got[("all", "custom:broken")] == (False, None)
    assert got[("all", "custom:raises")] == (False, None)


def test_validate_gold(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 1), ("b", 2.0, 3)], "k string, v double, n int")
    got = report_of(quality.validate_gold(df, "x"))
    assert got[("all", "row_count")] == (True, 3.0)
    assert not got[("all", "nulls:v")][0] and got[("all", "nulls:k")][0]
    assert got[("all", "no_duplicates")] == (False, 1.0)


def test_roll_ups(spark):
    good = spark.createDataFrame([(2020,)] * 3 + [(2021,)], "y int")
    rules = [quality.rows_rule(), quality.min_rows_rule(2, quality.ERROR)]
    report = quality.run_rules(good, rules, "bronze", F.col("y"))
    assert rows(quality.scope_results(report), "scope", "errors_count", "row_count", "passed") == [
        ("2020", 0, 3, True), ("2021", 1, 1, False),
    ]
    assert tuple(quality.summary(report).first()) == (2, 1, 1, 50.0)
    assert rows(quality.findings(report), "scope", "check") == [("2021", "min_rows")]
    assert tuple(quality.summary(report.limit(0)).first()) == (0, 0, 0, 0.0)


def test_row_conservation(spark):
    before = spark.createDataFrame([(2020,), (2020,), (2021,), (None,)], "y int")
    after = before.where("y is null or y = 2020")
    assert rows(quality.row_conservation(before, after, "y")) == [
        (2020, 2, 2, True), (2021, 1, 0, False), (None, 1, 1, True),
    ]


def test_type_checks(spark):
    df = spark.createDataFrame([("1", 1), ("x", 2), (None, 3)], "s string, i int")
    got = {r["column"]: (r["declared"], r["failing"], r["passed"])
           for r in quality.type_checks(df, {"s": "int", "i": "int"}).collect()}
    assert got == {"s": ("string", 1, False), "i": ("int", 0, True)}


def test_domain_is_case_blind_and_skips_nulls(spark):
    df = spark.createDataFrame([(" recife",), ("RECIFE",), (None,), ("olinda",)], "cidade string")
    rule = quality.domain_rule(Domain("cidade", ("RECIFE",)))
    assert quality.run_rules(df, [rule], "silver").first()["metric"] == 1.0
    assert Spec().domains[0].allowed == ("RECIFE",)
