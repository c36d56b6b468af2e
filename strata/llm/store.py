"""Shared storage for what a job keeps between its steps."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_shipped: set[str] = set()
#: Shuffle files of a finished write go at once rather than when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a session without one gets its own.

    A session that runs on one machine may do without the setting, as in tests. On a
    cluster its absence is an error, since executors share no local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="strata-"))
    return _own[0]


def ship_package(spark: SparkSession) -> None:
    """Let executors import this library, wherever they start from."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="strata-")).resolve() / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as made:
        for file in sorted(package.rglob("*.py")):
            made.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to shared storage and read back: lineage ends here.

    The files stay while the session may read them; a cluster's scratch folder is to expire.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
