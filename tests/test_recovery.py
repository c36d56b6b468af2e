"""Loads that recover from broken-off runs, take all files of a year, and rewrite only what changed."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.plans.pipeline import Pipeline
from strata.plans.registry import Options
from strata.sources import manifest, readers
from strata.sources.commits import Commits
from strata.sources.layers import Layers
from strata.spec import ROLES as R, YEAR_PARTITION
from tests.conftest import rows

HEAD = f"{R.year};{R.neighborhood};{R.use_type};{R.tax_value};{R.land_area};{R.built_area}"
STAMPS = ["_bronze_ingestion_timestamp", "_silver_timestamp", "_gold_timestamp"]


def write(path, year, *cells):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [f"{year};{place};{kind};{tax};10;20" for place, kind, tax in cells]
    path.write_text("\n".join([HEAD, *lines]) + "\n", encoding="utf-8")


def pipeline(spark, folder):
    return Pipeline(Layers(spark, str(folder)), Options(2024))


def run(line_up, raw, incremental=True):
    return line_up.run(str(raw), incremental=incremental, run_analysis=False)


def comparable(df):
    kept = sorted(c for c in df.columns if c not in STAMPS)
    return rows(df, *kept)


def tables(layers):
    names = ["summary_by_year_type", "summary_by_neighborhood", "year_over_year_trends", "full_consolidated"]
    found = {name: comparable(layers.read(layers.gold(name))) for name in names}
    return found | {"bronze": comparable(layers.read(layers.bronze)), "silver": comparable(layers.read(layers.silver))}


def years_folder(spark, raw):
    for year in (2020, 2021):
        write(raw / f"iptu_{year}.csv", year, ("A", "x", 1.5), ("B", "y", year), ("A", "y", ""))


def test_a_run_broken_off_anywhere_is_taken_up(spark, tmp_path, monkeypatch):
    """One lake, broken off before the commit, before silver and before gold in turn."""
    raw, lake = tmp_path / "raw", tmp_path / "lake"
    years_folder(spark, raw)
    run(pipeline(spark, lake), raw)

    class Stop(BaseException):
        pass

    def stop(*_, **__):
        raise Stop

    places = [(Commits, "add"), (Layers, "write_silver"), (Layers, "write_gold_years")]
    for step, (owner, name) in enumerate(places):
        write(raw / "iptu_2021.csv", 2021, ("A", "x", step), ("C", "z", 7))
        with monkeypatch.context() as patch:
            patch.setattr(owner, name, stop)
            with pytest.raises(Stop):
                run(pipeline(spark, lake), raw)
        after = pipeline(spark, lake)
        state = manifest.latest(manifest.read_log(spark, after.log_path)).where("year = 2021")
        assert rows(state, "processing_status") == [("completed" if step else "processing",)]
        run(after, raw)
        silver = after.silver().where(f"`{R.year}` = 2021")
        assert rows(silver, R.neighborhood, R.tax_value) == [("A", float(step)), ("C", 7.0)]
        trends = after.layers.read(after.layers.gold("year_over_year_trends")).where(f"`{R.year}` = 2021")
        assert rows(trends, "total_iptu_value") == [(7.0 + step,)]
    run(pipeline(spark, tmp_path / "whole"), raw, incremental=False)
    assert tables(Layers(spark, str(lake))) == tables(Layers(spark, str(tmp_path / "whole")))
    log = manifest.latest(manifest.read_log(spark, after.log_path))
    assert {r["processing_status"] for r in log.collect()} == {"completed"}
    assert after.years_to_load(readers.find_extracts(spark, str(raw)), True) == []
    assert after.years_to_consolidate([]) == after.years_to_summarise([]) == []


def test_a_claim_of_an_unchanged_file_is_given_back(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw / "iptu_2020.csv", 2020, ("A", "x", 1))
    first = pipeline(spark, tmp_path / "lake")
    first.catalog(str(raw))
    first._mark([str(raw / "iptu_2020.csv")], manifest.PROCESSING)
    state = pipeline(spark, tmp_path / "lake").catalog(str(raw))
    assert rows(state, "processing_status", "error_message") == [("pending", "an earlier run did not finish it")]


def test_lost_rows_of_a_year_are_loaded_again(spark, tmp_path):
    raw = tmp_path / "raw"
    years_folder(spark, raw)
    line_up = pipeline(spark, tmp_path / "lake")
    run(line_up, raw)
    line_up.layers.clear_year(line_up.layers.bronze, 2020)
    assert line_up.years_to_load(readers.find_extracts(spark, str(raw)), True) == [2020]


def test_all_files_of_a_year_are_loaded_and_others_reported(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw / "a" / "iptu_2023.csv", 2023, ("A", "x", 1))
    write(raw / "b" / "iptu_2023.csv", 2023, ("B", "x", 2), ("C", "x", 3))
    write(raw / "c" / "iptu_2023.csv", 2023, ("A", "x", 1))  # a copy of the first
    write(raw / "iptu-2022.csv", 2022, ("A", "x", 1))
    (raw / "notes.txt").write_text("x")
    line_up = pipeline(spark, tmp_path / "lake")
    silver = run(line_up, raw)
    assert rows(silver, R.neighborhood) == [("A",), ("B",), ("C",)]
    aside = spark.read.parquet(line_up.layers.path("catalog", "quarantine"))
    assert rows(aside, "relative_path", "year", "reason") == [
        ("c/iptu_2023.csv", 2023, f"same content as {raw}/a/iptu_2023.csv"),
        ("iptu-2022.csv", None, "not named like an extract"),
        ("notes.txt", None, "not named like an extract"),
    ]
    report = line_up.layers.read_report().where("layer = 'quarantine'")
    assert rows(report, "scope") == [("c/iptu_2023.csv",), ("iptu-2022.csv",), ("notes.txt",)]
    with pytest.raises(readers.SeveralExtracts):
        readers.find_extracts(spark, str(raw))
    # a file that joins or leaves a year makes it due; headers may differ between its files
    (raw / "b" / "iptu_2023.csv").unlink()
    (raw / "d").mkdir()
    (raw / "d" / "iptu_2023.csv").write_text(f"{R.year};{R.neighborhood};extra\n2023;D;e\n", encoding="utf-8")
    silver = run(pipeline(spark, tmp_path / "lake"), raw)
    assert rows(silver, R.neighborhood, "extra") == [("A", None), ("D", "e")]


def test_a_bad_file_fails_its_year_as_a_whole(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw / "iptu_2023.csv", 2023, ("A", "x", 1))
    line_up = pipeline(spark, tmp_path / "lake")
    run(line_up, raw)
    (raw / "b").mkdir()
    (raw / "b" / "iptu_2023.json").write_text("{}")
    assert rows(run(pipeline(spark, tmp_path / "lake"), raw), R.neighborhood) == [("A",)]
    paths = readers.resolve_extracts(spark, str(raw)).years
    assert line_up.years_to_load(paths, True) == [2023]


def test_checksums_need_no_whole_file(spark, tmp_path):
    """An edit of equal size and time is a change, however the file is split."""
    raw = tmp_path / "raw"
    raw.mkdir()
    files = {
        "iptu_2020.csv": HEAD + "\n" + "".join(f"2020;A;x;{i};1;1\n" for i in range(3000)),
        "iptu_2021.json": json.dumps({"records": [{"a": i, "b": "y"} for i in range(3000)]}),
        "iptu_2022.json": json.dumps({"fields": [{"id": "a"}], "records": [[i, "y"] for i in range(3000)]}),
    }
    for name, text in files.items():
        (raw / name).write_text(text)
        os.utime(raw / name, (1_600_000_000, 1_600_000_000))

    def sums():
        return {r["file_name"]: (r["md5_checksum"], r["file_size_bytes"], r["modified_at"]) for r in manifest.scan(spark, str(raw)).collect()}

    before = sums()
    assert len({s for s, _, _ in before.values()}) == 3
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert sums() == before
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, (old, new) in {"iptu_2020.csv": (";2999;", ";2998;"), "iptu_2021.json": ('"a": 2999', '"a": 2998'), "iptu_2022.json": ("[2999,", "[2998,")}.items():
        (raw / name).write_text(files[name].replace(old, new))
        os.utime(raw / name, (1_600_000_000, 1_600_000_000))
    # values that change places between records are a change too
    after = sums()
    assert [n for n in files if after[n] != before[n]] == ["iptu_2020.csv", "iptu_2021.json", "iptu_2022.json"]
    assert all(after[n][1:] == before[n][1:] for n in files)
    plan = manifest.scan(spark, str(raw))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_names_with_blanks_and_signs_have_checksums(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "iptu 2020+a%20é.csv").write_text("a\n1\n")
    one = manifest.scan(spark, str(tmp_path / "raw")).collect()
    (tmp_path / "raw" / "iptu 2020+a%20é.csv").write_text("a\n2\n")
    two = manifest.scan(spark, str(tmp_path / "raw")).collect()
    assert one[0]["md5_checksum"] != two[0]["md5_checksum"]
    assert one[0]["file_name"] == "iptu 2020+a%20é.csv"


def test_the_log_holds_what_the_load_saw(spark, tmp_path):
    raw = tmp_path / "raw"
    write(raw / "iptu_2020.csv", 2020, ("A", "x", 1), ("", "x", "z"))
    line_up = pipeline(spark, tmp_path / "lake")
    run(line_up, raw)
    done = manifest.latest(manifest.read_log(spark, line_up.log_path)).first()
    assert (done["row_count"], done["column_count"]) == (2, 6)
    schema = {c["column"]: (c["type"], c["nulls"]) for c in json.loads(done["schema_json"])}
    assert schema[R.year] == ("bigint", 0) and schema[R.neighborhood] == ("string", 1)
    assert schema[R.tax_value] == ("string", 0) and schema[R.land_area] == ("bigint", 0)


def test_only_changed_years_of_gold_are_rewritten(spark, tmp_path):
    raw = tmp_path / "raw"
    years_folder(spark, raw)
    line_up = pipeline(spark, tmp_path / "lake")
    run(line_up, raw)

    def files(folder):
        return {(p.parent.name, p.name) for p in folder.rglob("*.parquet")}

    gold = tmp_path / "lake" / "gold" / "full_consolidated"
    states = tmp_path / "lake" / "catalog" / "gold_states" / "summary_by_year_type"
    before = files(gold), files(states)
    write(raw / "iptu_2021.csv", 2021, ("A", "x", 9))
    run(pipeline(spark, tmp_path / "lake"), raw)
    for old, new in zip(before, (files(gold), files(states))):
        assert {year for year, _ in old ^ new} == {f"{YEAR_PARTITION}=2021"}
    # nothing changed: nothing is written
    known = files(gold), files(states)
    run(pipeline(spark, tmp_path / "lake"), raw)
    assert (files(gold), files(states)) == known
    # an emptied year leaves gold too
    write(raw / "iptu_2021.csv", 2021)
    run(pipeline(spark, tmp_path / "lake"), raw)
    trends = line_up.layers.read(line_up.layers.gold("year_over_year_trends"))
    assert rows(trends, R.year, "total_imoveis") == [(2020, 3)]
    assert not [year for year, _ in files(gold) if year.endswith("2021")]


def test_states_merge_to_what_one_aggregation_gives(spark):
    from strata.operators import gold, partials

    df = spark.range(500).select(
        (F.col("id") % 3 + 2020).cast("int").alias(R.year),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.col("id") % 4)).alias(R.use_type),
        F.when(F.col("id") % 5 > 0, F.col("id") * 1.0).alias(R.tax_value),
        (F.col("id") % 10).alias("part"),
    )
    states = partials.states(partials.states(df, [R.year, R.use_type, "part"], [R.tax_value]), [R.year, R.use_type, "part"], [R.tax_value])
    assert rows(gold.summary_by_year_type(states)) == rows(gold.summary_by_year_type(df))
    assert rows(gold.from_states(gold.states(df, "summary_by_year_type", along=["part"]), "summary_by_year_type")) == rows(gold.summary_by_year_type(df))
