"""What each layer holds of each year: an append-only table of commits.

A commit is one row a file in bronze and one row in silver and gold, appended in one write
after the year's rows are stored. Of a layer and year the newest commit counts. A layer is
behind another when its newest commit of a year does not name the other's newest one.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_SCHEMA = (
    "layer string, year int, commit_id string, source_id string, file_path string, "
    "md5_checksum string, row_count long, committed_at timestamp"
)


@dataclass(frozen=True)
class Commits:
    spark: SparkSession
    path: str

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], _SCHEMA)

    def _append(self, rows: DataFrame) -> None:
        stamped = rows.withColumn("committed_at", F.current_timestamp())
        stamped.select(*self.read().columns).write.mode("append").parquet(self.path)

    def add(self, layer: str, files: DataFrame, run_id: str) -> None:
        """The (year, file_path, md5_checksum, row_count) rows are now what the layer holds of the year."""
        named = files.withColumns(
            {
                "layer": F.lit(layer),
                "commit_id": F.concat_ws("-", F.lit(run_id), F.unix_micros(F.current_timestamp())),
                "source_id": F.lit(None).cast("string"),
            }
        )
        self._append(named)

    def follow(self, layer: str, made_from: DataFrame, run_id: str) -> None:
        """The layer now holds what was made from the (year, commit_id) rows."""
        nothing = {c: F.lit(None).cast(t) for c, t in (("file_path", "string"), ("md5_checksum", "string"), ("row_count", "long"))}
        named = made_from.select("year", F.col("commit_id").alias("source_id")).withColumns(
            {
                "layer": F.lit(layer),
                "commit_id": F.concat_ws("-", F.lit(run_id), F.unix_micros(F.current_timestamp())),
                **nothing,
            }
        )
        self._append(named)

    def latest(self, layer: str, years: Iterable[int] | None = None) -> DataFrame:
        """(year, commit_id, source_id) of each year's newest commit, computed at once."""
        known = self.read().where(F.col("layer") == layer)
        newest = known.groupBy("year").agg(F.max_by(F.struct("commit_id", "source_id"), "committed_at").alias("c"))
        if years is not None:
            newest = newest.where(F.col("year").isin(sorted(years)))
        rows = newest.select("year", "c.commit_id", "c.source_id").collect()
        return self.spark.createDataFrame(rows, "year int, commit_id string, source_id string")

    def known(self, layer: str) -> bool:
        return not self.read().where(F.col("layer") == layer).isEmpty()

    def years_behind(self, layer: str, source: str) -> list[int]:
        """Years whose newest commit in ``source`` the layer's newest one was not made from."""
        made = self.latest(layer).select("year", F.col("source_id").alias("made_from"))
        there = self.latest(source).join(made, "year", "left")
        behind = there.where(~F.col("commit_id").eqNullSafe(F.col("made_from")))
        return sorted(row["year"] for row in behind.collect())

    def years_unlike(self, present: DataFrame, stored: DataFrame) -> list[int]:
        """Years of the (year, file_path, md5_checksum) rows that the newest bronze commit did not load
        from just these files, or whose committed rows are not stored."""
        held = self.read().join(self.latest("bronze").select("year", "commit_id"), ["year", "commit_id"], "left_semi")
        files = ["year", "file_path", "md5_checksum"]
        loaded = held.select(*files)
        unlike = present.select(*files).exceptAll(loaded).unionAll(loaded.exceptAll(present.select(*files)))
        rows = held.groupBy("year").agg(F.sum("row_count").alias("rows")).where("rows > 0")
        lost = rows.join(stored, "year", "left_anti")
        return sorted({row["year"] for row in unlike.select("year").unionAll(lost.select("year")).distinct().collect()})
