"""The raw-file manifest: which files exist, whether they changed, what was done.

A manifest is a DataFrame over the file listing. Its history is an append-only
log of events; the state of a file is its latest event. An event names the run it
belongs to, so a claim whose run broke off is seen and given back.

A file's checksum is made of sums over its records, which executors compute from
splits of the file and combine: no file is held whole, whatever its size.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from strata.functions import sqltext
from strata.functions.scalars import quoted, year_in_name
from strata.operators.profile import per_column

PENDING = "pending"
PROCESSING = "processing"
COMPLETED = "completed"
FAILED = "failed"

EVENT_COLUMNS = [
    "file_path",
    "relative_path",
    "file_name",
    "year",
    "file_type",
    "file_size_bytes",
    "modified_at",
    "md5_checksum",
    "processing_status",
    "bronze_path",
    "error_message",
    "last_updated",
    "run_id",
    "row_count",
    "column_count",
    "schema_json",
]

_LATER_COLUMNS = {"run_id": "string", "row_count": "long", "column_count": "int", "schema_json": "string"}

#: Files that are looked at; hidden ones and those of other kinds are not extracts.
RAW_FILES = "*.{csv,json,parquet}"
#: Tokens of a JSON document within which the begin of its records is looked for.
HEAD_TOKENS = 5_000


def scan(
    spark: SparkSession, root: str, checksum: bool = True, pattern: str = RAW_FILES
) -> DataFrame:
    """One row per raw file below ``root``.

    Without ``checksum`` only the listing is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path", "length", "modificationTime", F.col("_metadata.file_path").alias("uri"))
    )
    if not checksum:
        return _described(files, root, F.lit(None).cast("string"))
    documents = [row["path"] for row in files.where(F.lower("path").endswith(".json")).select("path").collect()]
    # csv and parquet are cut at line ends, JSON documents behind each record
    parts = [_record_sums(spark, root, "\n", recursiveFileLookup="true", pathGlobFilter="*.{csv,CSV,parquet,PARQUET}")]
    by_end: dict[str, list[str]] = {}
    for path in documents:
        by_end.setdefault(record_end(spark, path), []).append(path)
    parts += [_record_sums(spark, paths, end) for end, paths in by_end.items()]
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    summed = files.join(sums, "uri", "left")
    figures = [F.coalesce(F.col(c), F.lit(0)).cast("string") for c in ("records", "s1", "s2")]
    return _described(summed, root, F.md5(F.concat_ws(":", F.col("length").cast("string"), *figures)))


def _record_sums(spark: SparkSession, paths: str | list[str], end: str, **options: str) -> DataFrame:
    """Per file the number of records and two sums of their hashes.

    The sums do not depend on how the file is split, nor on the records' order.
    """
    lines = spark.read.options(lineSep=end, **options).text(paths).select(F.col("_metadata.file_path").alias("uri"), "value")
    hashes = [F.sum(F.xxhash64(F.lit(seed), "value").cast("decimal(38,0)")).alias(f"s{seed}") for seed in (1, 2)]
    return lines.groupBy("uri").agg(F.count(F.lit(1)).alias("records"), *hashes)


def record_end(spark: SparkSession, path: str) -> str:
    """The bracket that ends a record of a JSON document: that of lists or of objects.

    Only the head of the document is looked at, up to where its records begin.
    """
    tokens = [row["value"].strip() for row in spark.read.options(lineSep=":").text(path).limit(HEAD_TOKENS).collect()]
    for before, after in zip(tokens, tokens[1:]):
        if before.endswith('"records"'):
            return "]" if after.replace(" ", "").replace("\n", "").startswith("[[") else "}"
    return "}"


def _described(files: DataFrame, root: str, md5: Column) -> DataFrame:
    path = F.regexp_replace("path", "^file:/+", "/")
    name = F.element_at(F.split(path, "/"), -1)
    base = root.removeprefix("file:").rstrip("/") + "/"
    relative = F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).otherwise(path)
    return files.select(
        path.alias("file_path"),
        relative.alias("relative_path"),
        name.alias("file_name"),
        year_in_name(path, name).alias("year"),
        F.lower(F.element_at(F.split(name, r"\."), -1)).alias("file_type"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("modified_at"),
        md5.alias("md5_checksum"),
    )


def changes(scanned: DataFrame, previous: DataFrame) -> DataFrame:
    """Each scanned file with ``change``: new, changed or unchanged.

    Checksums decide where both sides have one, else size and time do.
    """
    old = previous.select(
        "file_path",
        F.lit(True).alias("__known"),
        F.col("md5_checksum").alias("__md5"),
        F.col("file_size_bytes").alias("__size"),
        F.col("modified_at").alias("__modified"),
    )
    same_stat = (F.col("file_size_bytes") == F.col("__size")) & (
        F.col("modified_at") == F.col("__modified")
    )
    same = F.coalesce(F.col("md5_checksum") == F.col("__md5"), same_stat)
    change = (
        F.when(F.col("__known").isNull(), "new").when(same, "unchanged").otherwise("changed")
    )
    joined = scanned.join(old, "file_path", "left").withColumn("change", change)
    return joined.drop("__known", "__md5", "__size", "__modified")


def events(
    files: DataFrame,
    status: str,
    bronze_path: str | None = None,
    error: str | None = None,
    run_id: str | None = None,
    figures: DataFrame | None = None,
) -> DataFrame:
    """Log rows saying that ``files`` are now in ``status``.

    ``figures`` holds (file_path, row_count, column_count, schema_json) as observed by a load.
    """
    figure_columns = ["row_count", "column_count", "schema_json"]
    known = files.drop(*figure_columns)
    if figures is not None:
        known = known.join(figures, "file_path", "left")
    else:
        known = known.withColumns({c: F.lit(None).cast(_LATER_COLUMNS[c]) for c in figure_columns})
    return known.withColumns(
        {
            "processing_status": F.lit(status),
            "bronze_path": F.lit(bronze_path).cast("string"),
            "error_message": F.lit(error).cast("string"),
            "last_updated": F.current_timestamp(),
            "run_id": F.lit(run_id).cast("string"),
        }
    ).select(*EVENT_COLUMNS)


def append_events(rows: DataFrame, log_path: str) -> None:
    rows.write.mode("append").parquet(log_path)


def read_log(spark: SparkSession, log_path: str) -> DataFrame | None:
    try:
        log = spark.read.option("mergeSchema", "true").parquet(log_path)
    except AnalysisException:
        return None
    # a log written before these columns existed has no values for them
    return log.withColumns({c: F.lit(None).cast(t) for c, t in _LATER_COLUMNS.items() if c not in log.columns})


def latest(log: DataFrame) -> DataFrame:
    """The newest event per file, with the time the file was first seen.

    ``max_by`` over the whole row combines map-side; no window sorts a file's
    history.
    """
    row = F.struct(*[quoted(c) for c in log.columns])
    state = log.groupBy("file_path").agg(
        F.max_by(row, F.col("last_updated")).alias("__row"),
        F.min("last_updated").alias("discovery_timestamp"),
    )
    return state.select("__row.*", "discovery_timestamp")


def pending(log: DataFrame) -> DataFrame:
    return latest(log).where(F.col("processing_status") == PENDING)


def unfinished(log: DataFrame) -> DataFrame:
    """Files that a run claimed and neither finished nor gave up."""
    return latest(log).where(F.col("processing_status") == PROCESSING)


def file_metadata(log: DataFrame, year: int) -> DataFrame:
    return latest(log).where(F.col("year") == year)


def summary(state: DataFrame) -> DataFrame:
    """Files by status and by type, and their total size, as (metric, key, value) rows."""
    grouped = state.groupBy(
        F.col("processing_status").alias("status"), F.col("file_type").alias("type")
    ).agg(F.count(F.lit(1)).alias("files"), F.sum("file_size_bytes").alias("bytes"))

    def rows(metric: str, key: Column, amount: Column) -> DataFrame:
        counted = grouped.groupBy(key.alias("key")).agg(F.sum(amount).cast("double").alias("value"))
        return counted.select(F.lit(metric).alias("metric"), "key", "value")

    every = F.lit("all")
    gigabytes = rows("total_size_gb", every, F.col("bytes")).withColumn(
        "value", F.round(F.col("value") / 1024**3, 2)
    )
    parts = [
        rows("by_file_type", F.col("type"), F.col("files")),
        rows("total_files", every, F.col("files")),
        rows("total_size_bytes", every, F.col("bytes")),
        gigabytes,
    ]
    result = rows("by_status", F.col("status"), F.col("files"))
    for part in parts:
        result = result.unionByName(part)
    return result


def row_counts(frames: Mapping[int, DataFrame]) -> DataFrame:
    """(year, file_path, row_count, column_count) from the frames the readers give."""
    counted = [
        df.groupBy(F.regexp_replace(F.input_file_name(), "^file:/+", "/").alias("file_path"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.lit(year).alias("year"),
            "file_path",
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        for year, df in frames.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


def _type_sql(name: str) -> str:
    """bigint or double where every value of the column reads as one, else string."""
    text = f"CAST({sqltext.name(name)} AS STRING)"
    bad = "count_if({0} IS NOT NULL AND try_cast({0} AS {1}) IS NULL)"
    return (
        f"CASE WHEN count({text}) = 0 THEN 'string' "
        f"WHEN {bad.format(text, 'BIGINT')} = 0 THEN 'bigint' "
        f"WHEN {bad.format(text, 'DOUBLE')} = 0 THEN 'double' ELSE 'string' END"
    )


def schema_snapshot(df: DataFrame, file_path: str, sample_rows: int | None = None) -> DataFrame:
    """(file_path, position, column, type, sample_row_count) from all rows.

    A column is bigint or double when every value reads as one. ``sample_rows`` looks
    at so many rows only.
    """
    sample = df if sample_rows is None else df.limit(sample_rows)
    metrics = {name: {"type": _type_sql(name)} for name in df.columns}
    positions = F.array(*[F.lit(c) for c in df.columns])
    profile = per_column(sample, metrics)
    return profile.select(
        F.lit(file_path).alias("file_path"),
        F.array_position(positions, F.col("column")).cast("int").alias("position"),
        "column",
        "type",
        F.col("rows").alias("sample_row_count"),
    )


FIGURES_SCHEMA = "file_path string, row_count long, column_count int, schema_json string"


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` that counts rows, NULLs and readable types while it is loaded, without a scan of its own."""
    watch = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(df.columns):
        nulls = F.count_if(F.col(sqltext.name(name)).isNull())
        metrics += [F.expr(_type_sql(name)).alias(f"type_{i}"), nulls.alias(f"nulls_{i}")]
    return df.observe(watch, *metrics), watch


def load_figures(file_path: str, columns: Sequence[str], watch: Observation) -> tuple[str, int, int, str]:
    """What the load of one file saw, as a row of ``FIGURES_SCHEMA``."""
    seen = watch.get
    schema = [
        {"position": i + 1, "column": name, "type": seen[f"type_{i}"], "nulls": seen[f"nulls_{i}"]}
        for i, name in enumerate(columns)
    ]
    return file_path, seen["rows"], len(columns), json.dumps(schema, ensure_ascii=False)


def header_rows(spark: SparkSession, headers: Mapping[int, Sequence[str]]) -> DataFrame:
    """(year, column) rows of several files' headers."""
    rows = [(year, name) for year, names in headers.items() for name in names]
    return spark.createDataFrame(rows, "year int, column string")
