"""Every registered query against its SQL twin, and the shape of the plans."""

from __future__ import annotations

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, rows_of
from strata.plans.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(ORACLE_SQL[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python", plan)


def scans(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "FileScan" in line]


def test_counts_read_one_column(spark):
    scan = scans(QUERIES["volume_by_type"](spark, FOLDER))[0]
    assert scan.rstrip().endswith("ReadSchema: struct<o_orderpriority:string>")


def test_year_window_reaches_the_scan(spark, tmp_path):
    from strata.operators.evolution import neighborhood_evolution
    from strata.plans.tables import R, order_records

    path = str(tmp_path / "records")
    order_records(spark, FOLDER, R.neighborhood, R.year, R.tax_value, R.use_type).write.parquet(path)
    found = scans(neighborhood_evolution(spark.read.parquet(path), first_year=1996, last_year=1999))
    assert found
    for scan in found:
        assert f"GreaterThanOrEqual(`{R.year}`,1996)" in scan
        assert R.use_type not in scan


def test_top_k_is_cut_before_the_shuffle(spark):
    plan = QUERIES["top_k_per_year"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_orders_are_counted_before_the_customer_join(spark):
    plan = QUERIES["volume_by_neighborhood"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[o_custkey.*partial_count", plan)
