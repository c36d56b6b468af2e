"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads,
``BENCH_RUNS`` the timed runs per query (the median counts; one untimed run
comes first).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from strata.plans.queries import QUERIES

HEADLINE = [
    "volume_total",
    "volume_by_year",
    "volume_by_type",
    "volume_by_neighborhood",
    "volume_by_year_type",
    "volume_by_year_neighborhood",
    "distribution_top20",
    "top_k_per_year",
    "tax_stats_by_year",
    "avg_tax_top20",
    "property_value_by_year",
    "age_distribution",
    "age_statistics",
    "age_value",
    "evolution",
    "top_growth_quantity",
    "gold_year_type",
    "gold_neighborhood",
    "gold_trends",
    "align_year",
    "parse_currency",
    "union_years",
    "incremental_append",
    "boxplot_by_year",
    "numeric_summary",
    "categorical_top_values",
    "dq_null_profile",
    "dq_duplicate_keys",
    "dq_duplicate_rows",
    "dq_report",
    "dedup_rows",
    "export_refined",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
