"""Bronze, silver and gold tables on shared storage.

Each layer is a dataset of plain files, Parquet by default. Bronze and silver
are partitioned by fiscal year and overwritten dynamically: writing a year
replaces that year's folder and leaves the others, so a rerun after a lost
executor or a repeated load ends in the same state.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.functions.scalars import quoted
from strata.operators.align import require_columns, require_unique_columns
from strata.operators.gold import stamped
from strata.operators.quality import REPORT_SCHEMA, scope_results
from strata.spec import YEAR_PARTITION


@dataclass(frozen=True)
class Layers:
    """Where the layers live and in which format they are stored."""

    spark: SparkSession
    root: str
    format: str = "parquet"

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self.path("bronze")

    @property
    def silver(self) -> str:
        return self.path("silver")

    def gold(self, name: str) -> str:
        return self.path("gold", name)

    # ---- reading ----

    def exists(self, path: str) -> bool:
        try:
            self.spark.read.format(self.format).load(path)
        except AnalysisException:
            return False
        return True

    def read(self, path: str, years: Iterable[int] | None = None) -> DataFrame:
        """A stored layer. A ``years`` filter reads only those years' folders."""
        reader = self.spark.read.format(self.format)
        if self.format == "parquet":
            # Years written by different loads may differ in their extra columns.
            reader = reader.option("mergeSchema", "true")
        df = reader.load(path)
        if years is not None:
            df = df.where(quoted(YEAR_PARTITION).isin(sorted(years)))
        return df

    def read_gold(self, name: str, required: Sequence[str] = ()) -> DataFrame:
        """A gold table that must be there, hold the named columns and not be empty."""
        df = require_columns(self.read(self.gold(name)), required)
        if df.isEmpty():
            raise ValueError(f"gold table {name} is empty")
        return df

    def stored_years(self, path: str) -> DataFrame:
        """(year) for every stored year; an empty table when nothing is stored."""
        if not self.exists(path):
            return self.spark.createDataFrame([], "year int")
        stored = self.spark.read.format(self.format).load(path)
        return stored.select(quoted(YEAR_PARTITION).cast("int").alias("year")).distinct()

    # ---- writing ----

    def _write_years(self, df: DataFrame, path: str, every: bool = False, format: str | None = None) -> None:
        require_unique_columns(df)
        (
            df.write.format(format or self.format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "static" if every else "dynamic")
            .partitionBy(YEAR_PARTITION)
            .save(path)
        )

    def write_years(self, df: DataFrame, path: str, every: bool, gone: Iterable[int] = ()) -> None:
        """A table of partial states by year, as Parquet: all years, or those of ``df``; ``gone`` ones are removed."""
        self._write_years(df, path, every, "parquet")
        for year in gone:
            self.clear_year(path, year)

    def write_gold_years(self, df: DataFrame, name: str, every: bool, gone: Iterable[int] = ()) -> None:
        """A gold table partitioned by year, of which only the years of ``df`` are rewritten."""
        self._write_years(stamped(df, name), self.gold(name), every)
        for year in gone:
            self.clear_year(self.gold(name), year)

    def clear_year(self, path: str, year: int) -> None:
        """Remove a stored year that has no rows any more; overwriting would leave it."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{YEAR_PARTITION}={year}")
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def write_bronze(self, df: DataFrame) -> None:
        self._write_years(df, self.bronze)

    def write_silver(self, df: DataFrame) -> None:
        """Silver is made from bronze, so the path written is never the one read."""
        self._write_years(df, self.silver)

    def write_gold(self, df: DataFrame, name: str) -> None:
        """Every executor writes its own part; nothing passes through the driver."""
        stamped(df, name).write.format(self.format).mode("overwrite").save(self.gold(name))

    # ---- analysis results ----

    def write_result(self, df: DataFrame, family: str, name: str) -> None:
        """One analysis result as Parquet, and from there as CSV: computed once."""
        path = self.path("analyses", "parquet", family, name)
        df.write.mode("overwrite").parquet(path)
        csv = self.path("analyses", "csv", family, name)
        self.spark.read.parquet(path).write.mode("overwrite").csv(csv, header=True)

    def read_result(self, family: str, name: str, schema: StructType | None = None) -> DataFrame:
        """An analysis result: Parquet if there, else CSV, else an empty table."""
        try:
            return self.spark.read.parquet(self.path("analyses", "parquet", family, name))
        except AnalysisException:
            pass
        try:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.csv(
                self.path("analyses", "csv", family, name), header=True, inferSchema=schema is None
            )
        except AnalysisException:
            return self.spark.createDataFrame([], schema or StructType([]))

    # ---- quality reports ----

    def write_report(self, report: DataFrame, name: str = "validation_report") -> None:
        """All report rows as JSON, and from there the per-scope summary as CSV."""
        report.write.mode("overwrite").json(self.path("catalog", name))
        summary = scope_results(self.read_report(name))
        summary.write.mode("overwrite").csv(self.path("catalog", f"{name}_summary"), header=True)

    def read_report(self, name: str = "validation_report") -> DataFrame:
        return self.spark.read.schema(REPORT_SCHEMA).json(self.path("catalog", name))
