"""Scratch tables in the shared folder that the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from strata.operators.small_side import ensure_checkpoint_dir


def scratch_path(df: DataFrame, name: str) -> str:
    """A new path in the session's checkpoint folder; its files are the cluster's to expire."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored as Parquet and read back, so that it is computed once."""
    path = scratch_path(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
