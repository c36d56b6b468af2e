"""Size-checked use of small derived tables.

A derived table (one row per year, one row per column) has no size estimate
Catalyst can trust before it has run, so leaving the join to it may shuffle
the big side. Here the small side is computed first, and at most
``max_rows + 1`` of its rows are looked at. Within the bound it becomes a
local table, whose exact size Catalyst holds against its broadcast threshold.
Beyond the bound it is written through ``checkpoint()`` to the cluster's shared
folder, so it is not computed again, and joined as any table (adaptive
execution splits its hot partitions).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions.scalars import quoted

MAX_SMALL_ROWS = 10_000


def compute_once(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> DataFrame:
    """``df``'s result for repeated use: a local table when small, else checkpointed.

    Only in the second case is ``df`` computed again, to be written.
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows <= max_rows:
        return df.sparkSession.createDataFrame(head, df.schema)
    return checkpointed(df)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through the reliable checkpoint folder the cluster names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that ``spark.checkpoint.dir`` names."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(configured)


def keep_new_keys(incoming: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` whose ``key`` does not occur in ``existing`` (anti join).

    Rows with a NULL key are kept: they equal no stored key.
    """
    stored = existing.select(quoted(key)).where(quoted(key).isNotNull()).distinct()
    return incoming.join(stored, key, "left_anti").select(*[quoted(c) for c in incoming.columns])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; ``left``'s keys are kept."""
    renamed = right
    for i, key in enumerate(keys):
        renamed = renamed.withColumnRenamed(key, f"__right_{i}")
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & quoted(key).eqNullSafe(F.col(f"__right_{i}"))
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__right_{i}" for i in range(len(keys))])
