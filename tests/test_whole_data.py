"""No year, heading or file is left out, and changed files are loaded."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.scalars import year_in_name
from strata.operators import reshape, value
from strata.plans.pipeline import Pipeline
from strata.plans.registry import Options
from strata.sources import readers
from strata.sources.layers import Layers
from strata.spec import ROLES as R
from tests.conftest import rows

HEAD = f"{R.year};bairro;{R.tax_value}"


def write(folder, year, *lines):
    folder.mkdir(exist_ok=True)
    (folder / f"iptu_{year}.csv").write_text("\n".join([HEAD, *lines]) + "\n", encoding="utf-8")


def test_extracts_of_any_year_are_found(spark, tmp_path):
    for year in (1998, 2019, 2031):
        write(tmp_path, year, f"{year};A;1")
    (tmp_path / "iptu_2031").mkdir()
    (tmp_path / "iptu_2031" / "iptu_2031.csv").write_text(HEAD + "\n", encoding="utf-8")
    (tmp_path / "other.csv").write_text("a\n1\n", encoding="utf-8")
    found = readers.find_extracts(spark, str(tmp_path))
    assert list(found) == [1998, 2019, 2031] and "/iptu_2031/iptu_2031.csv" in found[2031]


def test_any_year_in_a_name(spark):
    names = spark.createDataFrame([("/a/2020/iptu_2019_2031.csv", "iptu_2019_2031.csv"), ("/a/2035/x.csv", "x.csv"), ("/a/b", "n120201.csv")], ["p", "n"])
    assert [r[0] for r in names.select(year_in_name(F.col("p"), F.col("n"))).collect()] == [2019, 2035, None]


def test_all_headings_are_pivoted(spark):
    df = spark.range(1200).select(F.lit(2020).alias(R.year), F.format_string("t%04d", "id").alias(R.use_type))
    assert len(reshape.pivot_year_type(df).columns) == 1201


def test_join_form_equals_one_aggregation(spark):
    schema = f"`{R.year}` int, `{R.tax_value}` double"
    for taxes in ([(None, 1.0), (None, 3.0), (2020, 0.0), (2021, 5.0), (2021, None)], [(None, 0.0), (2020, 0.0)]):
        df = spark.createDataFrame(taxes, schema)
        assert rows(value.tax_stats_by_year(df)) == rows(value.tax_stats_by_year_joined(df))


def test_incremental_runs_follow_changed_and_emptied_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    pipeline = Pipeline(Layers(spark, str(tmp_path / "lake")), Options(2024))

    def run():
        paths = readers.find_extracts(spark, str(raw))
        return pipeline.run(str(raw), paths, incremental=True, run_analysis=False)

    assert run().count() == 0  # no extract yet
    assert pipeline.layers.read_report().where("not passed").count() == 1
    write(raw, 2020, "2020;A;1")
    write(raw, 2021, "2021;A;1")
    assert run().count() == 2
    write(raw, 2020, "2020;A;1", "2020;B;2")
    assert sorted(r["bairro"] for r in run().where(f"`{R.year}` = 2020").collect()) == ["A", "B"]
    write(raw, 2021)
    assert [r[0] for r in run().select(R.year).distinct().collect()] == [2020]
