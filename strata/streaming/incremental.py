"""Incremental bronze loading as a file stream.

The stream picks up files it has not seen, aligns them and stores them by
year, then stops (``availableNow``). It is the incremental load for a folder
that keeps receiving one year's extract in parts: the stream's checkpoint
remembers the files, and each batch overwrites only its own folder, so a batch
repeated after a failure leaves no copies.

The stream itself is one of file names. Within a batch, files of equal headers are read
together and aligned by name, so headers may differ in names and in order.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.align import add_bronze_audit, align_year
from strata.sources.layers import Layers
from strata.sources.readers import read_delimited
from strata.spec import YEAR_PARTITION, Spec

#: Fixed: the columns of a stream of files; their content is not read by it.
FILES = "path string, modificationTime timestamp, length bigint, content binary"

BATCH = "_batch"


def by_header(spark: SparkSession, paths: list[str], sep: str) -> dict[tuple[str, ...], list[str]]:
    """The files by their header line, which is all that is read of them here."""
    found: dict[tuple[str, ...], list[str]] = {}
    for path in sorted(paths):
        found.setdefault(tuple(read_delimited(spark, path, sep).columns), []).append(path)
    return found


def stream_year(
    spark: SparkSession,
    folder: str,
    year: int,
    layers: Layers,
    checkpoint: str,
    spec: Spec = Spec(),
    sep: str = ";",
) -> StreamingQuery:
    """Load the files new in ``folder`` since the last call; all hold one year's rows."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.csv").load(folder)

    def store(batch: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in batch.collect()]
        parts = [
            add_bronze_audit(align_year(read_delimited(spark, some, sep), year, spec), year, folder)
            for header, some in by_header(spark, paths, sep).items()
            if header
        ]
        if not parts:
            return
        rows = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)
        (
            rows.withColumn(BATCH, F.lit(batch_id))
            .write.format(layers.format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(YEAR_PARTITION, BATCH)
            .save(layers.path("bronze_stream"))
        )

    return (
        files.select("path").writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
