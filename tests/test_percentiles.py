from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.operators import percentiles, small_side
from strata.operators.percentiles import exact_medians, exact_percentiles

MARKS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def expected(values):
    return np.percentile(values, [100 * m for m in MARKS])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 50, 1000])
def test_groups_match_numpy(spark, n):
    rnd = random.Random(n)
    data = [(1, float(rnd.randint(0, 3))) for _ in range(n)]
    data += [(2, rnd.gauss(0, 1e6)) for _ in range(n)]
    data += [(None, rnd.random()) for _ in range(n)]
    data += [(3, None)] * n
    df = spark.createDataFrame(data, "g int, v double")
    got = exact_percentiles(df, ["g"], F.col("v"), MARKS, [f"p{m}" for m in MARKS])
    found = {r["g"]: list(r)[1:] for r in got.collect()}
    assert found.pop(3) == [None] * len(MARKS)
    assert set(found) == {1, 2, None}
    for group, values in found.items():
        np.testing.assert_allclose(values, expected([v for g, v in data if g == group]))


def test_sketch_of_little_accuracy_still_gives_exact_values(spark):
    """A third of the rows share one key and one value repeats often."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("int").alias("g"),
        F.when(F.col("id") % 7 == 0, 1.0).otherwise(F.abs(F.hash("id")) / 1000.0).alias("v"),
    )
    got = exact_percentiles(df, ["g"], F.col("v"), [0.25, 0.5, 0.9], ["a", "b", "c"], accuracy=100)
    want = df.groupBy("g").agg(F.percentile("v", [0.25, 0.5, 0.9]).alias("p"))
    found = {r["g"]: [r["a"], r["b"], r["c"]] for r in got.collect()}
    for row in want.collect():
        np.testing.assert_allclose(found[row["g"]], row["p"])


def test_whole_table_and_empty_table(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert exact_medians(df, [], F.col("v"), "m").collect() == [(2.5,)]
    assert exact_medians(df.limit(0), [], F.col("v"), "m").collect() == [(None,)]
    along = {"n": "count(1)", "least": "min(__v)"}
    got = exact_percentiles(df, [], F.col("v"), [0.5], ["m"], along)
    assert got.columns == ["n", "least", "m"] and got.collect() == [(4, 1.0, 2.5)]
    keyed = df.withColumn("g", F.lit(1))
    assert exact_medians(keyed.limit(0), ["g"], F.col("v"), "m").collect() == []


def test_many_groups_take_the_join_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(
        percentiles, "compute_once", lambda df: small_side.compute_once(df, max_rows=5)
    )
    df = spark.range(2000).select((F.col("id") % 50).alias("g"), F.col("id").cast("double").alias("v"))
    got = exact_medians(df, ["g"], F.col("v"), "m")
    want = df.groupBy("g").agg(F.median("v").alias("m"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_keep_new_keys_keeps_null_keys(spark):
    incoming = spark.range(3000).selectExpr("nullif(id, 2999) AS k")
    existing = spark.range(1500).selectExpr("nullif(id, 7) AS k")
    kept = small_side.keep_new_keys(incoming, existing, "k")
    assert sorted(r["k"] for r in kept.collect() if r["k"] is not None) == [7, *range(1500, 2999)]
    assert kept.where("k IS NULL").count() == 1


def test_checkpoint_folder_comes_from_the_session(spark):
    small_side.ensure_checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in spark.sparkContext.getCheckpointDir()
