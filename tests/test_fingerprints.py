"""Copies of rows by hashes, collisions included, and pivots of any width."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators import profile, reshape, volume
from strata.spec import ROLES as R
from tests.conftest import rows

NESTED = "a int, t string, d double, l array<string>"


@pytest.fixture
def table(spark):
    data = [
        (1, "x", 0.0, ["p", None]), (1, "x", -0.0, ["p", None]), (1, "x", 0.0, [None, "p"]), (None, "x", 1.0, None),
        (None, "x", 1.0, None), (1, None, 1.0, []), (None, "1", 1.0, []), (2, "", float("nan"), ["q"]), (2, "", float("nan"), ["q"]),
    ]
    return spark.createDataFrame(data * 2 + [(9, "only", 1.0, [])], NESTED)


def by_values(df):
    groups = df.groupBy(*df.columns).count()
    return groups.agg(F.sum("count"), F.count_if(F.col("count") > 1), F.sum(F.col("count") - 1)).first()


def test_copies_are_counted_by_hashes(table):
    assert tuple(profile.duplicate_rows(table).first()) == tuple(by_values(table))
    assert profile.duplicate_rows(table.limit(0)).collect() == [(0, 0, 0)]


@pytest.mark.parametrize("equal", [2, 1])
def test_rows_of_equal_hashes_are_compared(table, monkeypatch, equal):
    """Hashes that agree for all rows, or for all rows of one value."""
    hashes = profile.row_hashes

    def weak(df, columns):
        third = hashes(df, columns)[2]
        first = F.lit(7).cast("long") if equal == 2 else F.xxhash64("a")
        return [first.alias("__h1"), F.lit(7).cast("long").alias("__h2"), third]

    monkeypatch.setattr(profile, "row_hashes", weak)
    assert tuple(profile.duplicate_rows(table).first()) == tuple(by_values(table))
    overview = profile.dataset_overview(table, "t")
    want = table.groupBy(*table.columns).count().groupBy("t").agg(F.sum(F.col("count") - 1).alias("duplicate_rows"))
    assert rows(overview, "t", "duplicate_rows") == rows(want)


def test_text_is_not_shuffled_to_count_copies(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(500).select((F.col("id") % 50).alias("k"), F.concat(F.lit("text"), F.col("id") % 50).alias("t")).write.parquet(path)
    found = profile.duplicate_rows(spark.read.parquet(path))
    assert found.collect() == [(500, 50, 450)]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(__h1" in plan and "hashpartitioning(k" not in plan


def test_pivots_of_thousands_of_headings(spark):
    df = spark.range(10_000).select((F.col("id") % 2 + 2020).cast("int").alias(R.year), F.format_string("t%04d", F.col("id") % 5000).alias(R.use_type))
    counts = volume.volume_by_year_type(df)
    cells = {r["ano"]: r["cells"] for r in reshape.pivot_map(counts, "ano", "tipo_uso", "total_imoveis").collect()}
    assert {y: len(c) for y, c in cells.items()} == {2020: 2500, 2021: 2500}
    wide = reshape.pivot_year_type(df)
    assert len(wide.columns) == 5001
    few = spark.createDataFrame([(2020, "a"), (2020, None), (None, "a"), (2021, None), (2020, "a")], f"`{R.year}` int, `{R.use_type}` string")
    assert rows(reshape.pivot_year_type(few)) == rows(spark.createDataFrame([(2020, 2), (2021, 0), (None, 1)], "ano int, a long"))


def test_all_counted_outputs_may_leave_out_rows_without_key(spark):
    df = spark.createDataFrame([(2020, "a", "p", "c"), (None, None, None, None), (2020, "a", None, "c")], f"`{R.year}` int, `{R.use_type}` string, {R.neighborhood} string, `{R.construction_type}` string")
    for name in ("volume_by_year", "volume_by_type", "volume_by_neighborhood", "volume_by_year_type", "volume_by_year_neighborhood", "distribution_by_type",
                 "distribution_by_neighborhood_top", "distribution_by_year", "distribution_by_construction", "top_neighborhoods_by_year"):
        kept = getattr(volume, name)(df, drop_null_keys=True).collect()
        assert kept and all(value is not None for row in kept for value in row), name
    assert volume.distribution_by_year(df, drop_null_keys=True).collect()[0]["percentual"] < 70
