from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from strata.operators import export
from strata.operators.align import SchemaError
from strata.sources import manifest, readers
from strata.sources.layers import Layers
from strata.spec import YEAR_PARTITION
from tests.conftest import rows


def test_read_delimited_is_all_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("nome;valor IPTU\nJosé;R$ 1,5\n;2\n", encoding="utf-8")
    df = readers.read_delimited(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("nome", "string"), ("valor IPTU", "string")]
    assert rows(df) == [("José", "R$ 1,5"), (None, "2")]


DUMP = {
    "fields": [{"id": "_id", "type": "int"}, {"id": "valor IPTU", "type": "numeric"}],
    "records": [[1, "10,5"], [2, 3.25], [3, None], [4]],
}


def test_read_datastore_dump(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps(DUMP, indent=1), encoding="utf-8")
    df = readers.read_json(spark, str(path))
    assert df.dtypes == [("_id", "string"), ("valor IPTU", "string")]
    assert rows(df) == [("1", "10,5"), ("2", "3.25"), ("3", None), ("4", None)]


def test_read_record_json(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"records": [{"a": 1}, {"a": 2, "b": "x"}]}), encoding="utf-8")
    assert rows(readers.read_json(spark, str(path)), "a", "b") == [(1, None), (2, "x")]


def test_find_extracts_prefers_the_folder(spark, tmp_path):
    (tmp_path / "iptu_2020").mkdir()
    (tmp_path / "iptu_2020" / "iptu_2020.csv").write_text("a\n1\n")
    (tmp_path / "iptu_2020.csv").write_text("a\n1\n")
    (tmp_path / "iptu_2021.csv").write_text("a\n1\n")
    (tmp_path / "iptu_2024_json.json").write_text("{}")
    found = readers.find_extracts(spark, str(tmp_path))
    assert {y: p.removeprefix(str(tmp_path)) for y, p in found.items()} == {
        2020: "/iptu_2020/iptu_2020.csv", 2021: "/iptu_2021.csv", 2024: "/iptu_2024_json.json",
    }


def test_manifest_scan_and_changes(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "iptu_2020").mkdir(parents=True)
    one, two = raw / "iptu_2020" / "iptu_2020.csv", raw / "dados_2021.json"
    one.write_text("a;b\n1;2\n")
    two.write_text("{}")
    first = manifest.scan(spark, str(raw))
    got = {r["relative_path"]: r for r in first.collect()}
    assert set(got) == {"iptu_2020/iptu_2020.csv", "dados_2021.json"}
    entry = got["iptu_2020/iptu_2020.csv"]
    assert (entry["year"], entry["file_type"], entry["file_size_bytes"]) == (2020, "csv", 8)
    assert len(entry["md5_checksum"]) == 32

    log = str(tmp_path / "log")
    manifest.append_events(manifest.events(first, manifest.PENDING), log)
    one.write_text("a;b\n1;3\n")
    (raw / "iptu_2022.csv").write_text("a\n")
    known = manifest.latest(manifest.read_log(spark, log))
    compared = manifest.changes(manifest.scan(spark, str(raw)), known)
    assert rows(compared, "file_name", "change") == [
        ("dados_2021.json", "unchanged"), ("iptu_2020.csv", "changed"), ("iptu_2022.csv", "new"),
    ]
    listing = manifest.scan(spark, str(raw), checksum=False)
    assert rows(listing, "md5_checksum") == [(None,)] * 3
    assert rows(manifest.changes(listing, known), "change").count(("new",)) == 1


def test_manifest_state_is_the_latest_event(spark, tmp_path):
    (tmp_path / "iptu_2020.csv").write_text("a\n1\n")
    (tmp_path / "iptu_2021.csv").write_text("a\n1\n")
    log = str(tmp_path / "log")
    files = manifest.scan(spark, str(tmp_path))
    manifest.append_events(manifest.events(files, manifest.PENDING), log)
    first = files.where("year = 2020")
    manifest.append_events(manifest.events(first, manifest.PROCESSING), log)
    manifest.append_events(manifest.events(first, manifest.FAILED, error="bad header"), log)
    history = manifest.read_log(spark, log)
    state = manifest.latest(history)
    assert rows(state, "year", "processing_status", "error_message") == [
        (2020, "failed", "bad header"), (2021, "pending", None),
    ]
    assert all(r["discovery_timestamp"] <= r["last_updated"] for r in state.collect())
    assert rows(manifest.pending(history), "year") == [(2021,)]
    assert manifest.file_metadata(history, 2020).count() == 1
    assert rows(manifest.summary(state)) == [
        ("by_file_type", "csv", 2.0), ("by_status", "failed", 1.0), ("by_status", "pending", 1.0),
        ("total_files", "all", 2.0), ("total_size_bytes", "all", 8.0), ("total_size_gb", "all", 0.0),
    ]
    assert manifest.read_log(spark, str(tmp_path / "none")) is None


def test_row_counts_and_schema_snapshot(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("n;d;t;e\n1;1.5;a;\n2;3;4;\n")
    df = readers.read_delimited(spark, str(path))
    assert rows(manifest.row_counts({2020: df})) == [(2020, str(path), 2, 4)]
    assert rows(manifest.schema_snapshot(df, "x"), "position", "column", "type", "sample_row_count") == [
        (1, "n", "bigint", 2), (2, "d", "double", 2), (3, "t", "string", 2), (4, "e", "string", 2),
    ]


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "lake"))


def yearly(spark, data):
    return spark.createDataFrame(data, f"`valor IPTU` double, {YEAR_PARTITION} int")


def test_bronze_keeps_other_years(spark, layers):
    assert layers.stored_years(layers.bronze).count() == 0
    layers.write_bronze(yearly(spark, [(1.0, 2020), (2.0, 2021)]))
    layers.write_bronze(yearly(spark, [(9.0, 2021)]))
    layers.write_bronze(yearly(spark, [(9.0, 2021)]))
    assert rows(layers.read(layers.bronze), "valor IPTU", YEAR_PARTITION) == [(1.0, 2020), (9.0, 2021)]
    assert rows(layers.stored_years(layers.bronze)) == [(2020,), (2021,)]


def test_extra_column_of_one_year_survives(spark, layers):
    layers.write_bronze(yearly(spark, [(1.0, 2020)]))
    layers.write_bronze(yearly(spark, [(2.0, 2021)]).withColumn("_id", F.lit("7")))
    assert rows(layers.read(layers.bronze), "valor IPTU", "_id") == [(1.0, None), (2.0, "7")]


def test_year_filter_reads_only_its_folder(spark, layers):
    layers.write_bronze(yearly(spark, [(1.0, 2020), (2.0, 2021)]))
    one = layers.read(layers.bronze, [2021])
    assert rows(one, "valor IPTU") == [(2.0,)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert YEAR_PARTITION in partition_filters and "2021" in partition_filters


def test_gold_guard(spark, layers):
    layers.write_gold(spark.range(2), "numbers")
    assert layers.read_gold("numbers", ["id"]).columns == ["id", "_gold_timestamp", "_output_type"]
    with pytest.raises(SchemaError):
        layers.read_gold("numbers", ["other"])
    layers.write_gold(spark.range(0), "nothing")
    with pytest.raises(ValueError):
        layers.read_gold("nothing")


def test_results_fall_back_to_csv_then_to_empty(spark, layers):
    df = spark.createDataFrame([(2020, "x")], "ano int, tipo string")
    layers.write_result(df, "fam", "res")
    assert rows(layers.read_result("fam", "res")) == [(2020, "x")]
    df.write.csv(layers.path("analyses", "csv", "fam", "only_csv"), header=True)
    assert rows(layers.read_result("fam", "only_csv")) == [(2020, "x")]
    empty = layers.read_result("fam", "absent", df.schema)
    assert empty.schema == df.schema and empty.isEmpty()


def test_export(spark, tmp_path):
    import datetime as dt

    stamp = dt.datetime(2020, 5, 6, 7, 8)
    df = spark.createDataFrame(
        [(1, stamp, "b", "x", 2020), (1, stamp, "b", "x", 2020), (2, stamp, "b", "y", 2021)],
        f"_id int, quando timestamp, _data_layer string, bairro string, {YEAR_PARTITION} int",
    )
    path = str(tmp_path / "out")
    export.write_refined(df, path, files=1)
    saved = spark.read.parquet(path)
    assert saved.dtypes == [("_id", "int"), ("quando", "date"), ("bairro", "string")]
    assert rows(saved, "_id", "bairro") == [(1, "x"), (2, "y")]
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 1
    assert rows(export.refined(df, 2021), "_id") == [(2,)]
