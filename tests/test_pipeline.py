from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from strata.__main__ import main
from strata.plans.pipeline import Pipeline
from strata.plans.registry import Options
from strata.sources import manifest, readers
from strata.sources.layers import Layers
from strata.spec import CANONICAL_COLUMNS, ROLES as R
from strata.streaming.incremental import stream_year
from tests.conftest import rows

NAMES = [name for name, _ in CANONICAL_COLUMNS]
STAMPS = ["_bronze_ingestion_timestamp", "_silver_timestamp"]


def line(year, i):
    cells = dict.fromkeys(NAMES, "")
    cells.update({
        R.entity: str(i), R.year: str(year), R.registered: f"{year}/1/{i % 27 + 1} 00:00:00.000000000",
        R.neighborhood: f" BAIRRO {i % 3} ", R.city: "RECIFE", R.state: "PE", R.land_area: "10,5",
        R.built_area: "20", R.built_year: str(1960 + i % 50), R.use_type: f"TIPO {i % 2}",
        R.property_value: f"R$ {i},00", R.tax_value: f"{(i % 7) * 10},5", R.postal_code: "50000001",
        R.construction_type: "CASA",
    })
    return cells


def write_csv(path, year, count=120):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [";".join(NAMES)]
    lines += [";".join(line(year, i)[n] for n in NAMES) for i in range(count)]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def write_dump(path, year, count=120):
    names = ["_id"] + ["quantidade de pavimentos" if n == "quant pavimentos" else n for n in NAMES]
    records = [[i, *[line(year, i)[n] or None for n in NAMES]] for i in range(count)]
    path.write_text(json.dumps({"fields": [{"id": n} for n in names], "records": records}), encoding="utf-8")


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for year in (2020, 2021):
        write_csv(root / f"iptu_{year}" / f"iptu_{year}.csv", year)
    write_csv(root / "iptu_2022.csv", 2022)
    write_dump(root / "iptu_2024_json.json", 2024)
    return root


def pipeline(spark, folder):
    return Pipeline(Layers(spark, str(folder)), Options(reference_year=2024))


@pytest.fixture(scope="module")
def full(spark, raw, tmp_path_factory):
    line_up = pipeline(spark, tmp_path_factory.mktemp("full"))
    paths = readers.find_extracts(spark, str(raw))
    line_up.run(str(raw), paths)
    return line_up


def comparable(df):
    return rows(df.drop(*STAMPS), *sorted(c for c in df.columns if c not in STAMPS))


def test_silver_holds_every_row_once(full):
    silver = full.silver()
    assert rows(silver.groupBy(R.year).count()) == [(2020, 120), (2021, 120), (2022, 120), (2024, 120)]
    assert dict(silver.dtypes)[R.tax_value] == "double"
    assert silver.where(F.col(R.neighborhood) == "BAIRRO 1").count() == 160
    assert silver.where("_id is not null").count() == 120


def test_gold_and_analyses_are_stored(full):
    layers = full.layers
    trends = layers.read_gold("year_over_year_trends", ["total_imoveis"])
    assert rows(trends, R.year, "total_imoveis") == [(2020, 120), (2021, 120), (2022, 120), (2024, 120)]
    assert layers.read_gold("full_consolidated").count() == 480
    assert layers.read_result("volume_analysis", "total_properties").first()["value"] == 480
    evolution = layers.read_result("evolution_analysis", "neighborhood_evolution")
    assert rows(evolution, "bairro", "crescimento_quantidade") == [
        ("BAIRRO 0", 0.0), ("BAIRRO 1", 0.0), ("BAIRRO 2", 0.0),
    ]
    assert layers.read_result("report", "summary_report").count() > 10


def test_reports_and_run_summary(spark, full):
    report = spark.read.json(full.layers.path("catalog", "validation_report"))
    layers = {r["layer"] for r in report.select("layer").distinct().collect()}
    assert {"raw", "bronze", "silver", "gold_summary_by_year_type"} <= layers
    assert report.where("`check` = 'row_conservation' and not passed").count() == 0
    assert full.completed_analyses().count() == 21
    overview = full.run_summary([2020, 2023, 2024])
    assert rows(overview, "year", "ingested", "processing_status") == [
        (2020, True, "completed"), (2023, False, None), (2024, True, "completed"),
    ]


def test_incremental_runs_end_where_a_full_run_does(spark, raw, full, tmp_path):
    step = pipeline(spark, tmp_path / "lake")
    paths = readers.find_extracts(spark, str(raw))
    step.run(str(raw), {2020: paths[2020]}, run_analysis=False)
    step.run(str(raw), {y: paths[y] for y in (2020, 2021)}, incremental=True, run_analysis=False)
    assert step.years_to_load(paths, incremental=True) == [2022, 2024]
    step.load_bronze({2022: paths[2022]})
    assert step.years_to_consolidate([]) == [2022]
    step.run(str(raw), paths, incremental=True, run_analysis=False)
    assert comparable(step.silver()) == comparable(full.silver())
    assert comparable(step.layers.read(step.layers.bronze)) == comparable(full.layers.read(full.layers.bronze))
    assert step.years_to_load(paths, incremental=True) == []


def test_command_line(spark, raw, tmp_path):
    lake, out = str(tmp_path / "lake"), str(tmp_path / "out")
    base = ["run", "--raw", str(raw), "--lake", lake, "--reference-year", "2024", "--no-analysis"]
    main([*base, "--years", "2020"])
    main([*base, "--years", "2020", "2021", "--incremental"])
    main(["export", "--lake", lake, "--output", out, "--year", "2021", "--files", "1"])
    exported = spark.read.parquet(out)
    assert rows(exported.groupBy(R.year).count()) == [(2021, 120)]
    assert not [c for c in exported.columns if c.startswith("_")]
    main(["export", "--lake", lake, "--output", out])
    assert spark.read.parquet(out).count() == 240


def test_a_bad_file_does_not_stop_the_rest(spark, raw, tmp_path):
    broken = tmp_path / "raw" / "iptu_2021.json"
    broken.parent.mkdir()
    broken.write_text("{}")
    good = tmp_path / "raw" / "iptu_2020.csv"
    write_csv(good, 2020)
    line_up = pipeline(spark, tmp_path / "lake")
    line_up.catalog(str(tmp_path / "raw"))
    line_up.load_bronze({2020: str(good), 2021: str(broken)})
    state = manifest.latest(manifest.read_log(spark, line_up.log_path))
    assert rows(state, "year", "processing_status") == [(2020, "completed"), (2021, "failed")]
    assert rows(line_up.layers.stored_years(line_up.layers.bronze)) == [(2020,)]


def test_second_catalog_logs_only_changes(spark, raw, tmp_path):
    line_up = pipeline(spark, tmp_path / "lake")
    line_up.catalog(str(raw))
    before = manifest.read_log(spark, line_up.log_path).count()
    line_up.catalog(str(raw))
    assert manifest.read_log(spark, line_up.log_path).count() == before == 4


def test_stream_loads_each_file_once(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "lake"))
    folder = tmp_path / "incoming"
    write_csv(folder / "part1.csv", 2020, 5)

    def load():
        stream_year(spark, str(folder), 2020, layers, str(tmp_path / "ck")).awaitTermination()
        return spark.read.parquet(layers.path("bronze_stream"))

    assert load().count() == 5
    write_csv(folder / "part2.csv", 2020, 3)
    assert load().count() == 8
    stored = load()
    assert stored.count() == 8
    assert dict(stored.dtypes)[R.tax_value] == "double"


def test_stream_takes_files_of_any_header(spark, tmp_path):
    layers, folder = Layers(spark, str(tmp_path / "lake")), tmp_path / "incoming"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{R.year};{R.neighborhood};{R.tax_value}\n2020;A;1,5\n", encoding="utf-8")
    (folder / "b.csv").write_text(f"{R.tax_value};extra;{R.neighborhood};{R.year}\n2,5;e;B;2020\n", encoding="utf-8")
    (folder / "c.csv").write_text(f"{R.year};{R.neighborhood};{R.tax_value}\n2020;C;3,5\n", encoding="utf-8")
    (folder / "d.csv").write_text("", encoding="utf-8")
    stream_year(spark, str(folder), 2020, layers, str(tmp_path / "ck")).awaitTermination()
    stored = layers.read(layers.path("bronze_stream"))
    assert rows(stored, R.neighborhood, R.tax_value, "extra") == [("A", 1.5, None), ("B", 2.5, "e"), ("C", 3.5, None)]
