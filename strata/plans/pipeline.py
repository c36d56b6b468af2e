"""Raw files to gold tables, analyses and a quality report.

Each layer is written before the next reads it, so a lost executor costs a
task's work and never the lineage of the whole run.

What a layer holds of a year is told by commits, written after the year is stored. A
bronze commit names the year's files with the checksums that were loaded; a silver or
gold commit names the commit it was made from. A year is due in a layer when its last commit
there is not of what is there now, so a run that broke off anywhere is taken up
again by the next one. One run at a time writes a lake.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from strata.functions.scalars import quoted
from strata.operators import align, gold, quality
from strata.plans.registry import (
    ANALYSES,
    GOLD_OUTPUTS,
    REPORTS,
    Options,
    available,
    build_all,
    counts_for,
)
from strata.sources import commits, manifest, readers
from strata.sources.layers import Layers
from strata.spec import YEAR_PARTITION, Spec


def paths_of(files: str | Sequence[str]) -> list[str]:
    """A year's files as the manifest names them."""
    return [path.removeprefix("file:") for path in ([files] if isinstance(files, str) else files)]


@dataclass
class Pipeline:
    layers: Layers
    options: Options
    spec: Spec = Spec()
    separator: str = ";"
    #: names this run in the log and in commits
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def commits(self) -> commits.Commits:
        return commits.Commits(self.layers.spark, self.layers.path("catalog", "commits"))

    @property
    def log_path(self) -> str:
        return self.layers.path("catalog", "manifest_log")

    # ---- raw ----

    def catalog(self, raw_root: str) -> DataFrame:
        """Scan the raw files; log the new and the changed ones as pending.

        So are those that another run claimed and did not finish.
        """
        spark = self.layers.spark
        scanned = manifest.scan(spark, raw_root)
        log = manifest.read_log(spark, self.log_path)
        if log is not None:
            compared = manifest.changes(scanned, manifest.latest(log))
            scanned = compared.where(F.col("change") != "unchanged").drop("change")
            open_ = manifest.unfinished(log).where(~F.col("run_id").eqNullSafe(F.lit(self.run_id)))
            left = compared.where(F.col("change") == "unchanged").join(open_.select("file_path"), "file_path", "left_semi")
            given_back = manifest.events(left, manifest.PENDING, error="an earlier run did not finish it")
            manifest.append_events(given_back, self.log_path)
        manifest.append_events(manifest.events(scanned, manifest.PENDING), self.log_path)
        return manifest.latest(manifest.read_log(spark, self.log_path))

    def _mark(
        self, paths: Sequence[str], status: str, error: str | None = None, figures: DataFrame | None = None
    ) -> None:
        log = manifest.read_log(self.layers.spark, self.log_path)
        if log is None:
            return
        files = manifest.latest(log).where(F.col("file_path").isin(paths))
        rows = manifest.events(files, status, self.layers.bronze, error, self.run_id, figures)
        manifest.append_events(rows, self.log_path)

    # ---- bronze ----

    def _present(self, paths: Mapping[int, str | Sequence[str]]) -> DataFrame:
        """(year, file_path, md5_checksum) of the years' files as last cataloged."""
        spark = self.layers.spark
        files = [(year, path) for year, some in paths.items() for path in paths_of(some)]
        present = spark.createDataFrame(files, "year int, file_path string")
        log = manifest.read_log(spark, self.log_path)
        if log is None:
            return present.withColumn("md5_checksum", F.lit(None).cast("string"))
        return present.join(manifest.latest(log).select("file_path", "md5_checksum"), "file_path", "left").select(
            "year", "file_path", "md5_checksum"
        )

    def years_to_load(self, paths: Mapping[int, str | Sequence[str]], incremental: bool) -> list[int]:
        """Years asked for; incrementally those whose files are not what their last commit
        loaded, and those committed with rows but not stored."""
        if not incremental:
            return sorted(paths)
        return sorted(set(self.commits.years_unlike(self._present(paths), self.layers.stored_years(self.layers.bronze))) & set(paths))

    def load_bronze(self, paths: Mapping[int, str | Sequence[str]], incremental: bool = False) -> list[DataFrame]:
        """Align and store each year's files together. Returns the raw checks of each file.

        A year with a file that cannot be read is marked failed and does not stop the rest.
        Rows, NULLs and types of each file are counted by the write itself.
        """
        reports = []
        for year in self.years_to_load(paths, incremental):
            files = paths_of(paths[year])
            self._mark(files, manifest.PROCESSING)
            try:
                watches, parts = {}, []
                for path in files:
                    raw = readers.read_extract(self.layers.spark, path, self.separator)
                    reports.append(quality.validate_raw(raw, year, self.spec))
                    seen, watch = manifest.observed(raw)
                    watches[path] = raw.columns, watch
                    parts.append(align.add_bronze_audit(align.align_year(seen, year, self.spec), year, path))
                self.layers.write_bronze(reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts))
            except (PySparkException, align.SchemaError, ValueError) as problem:
                self._mark(files, manifest.FAILED, str(problem).splitlines()[0])
                continue
            figures = [manifest.load_figures(path, columns, watch) for path, (columns, watch) in watches.items()]
            if not any(rows for _, rows, _, _ in figures):
                self.layers.clear_year(self.layers.bronze, year)
            table = self.layers.spark.createDataFrame(figures, manifest.FIGURES_SCHEMA)
            self.commits.add("bronze", self._present({year: files}).join(table.select("file_path", "row_count"), "file_path"), self.run_id)
            self._mark(files, manifest.COMPLETED, figures=table)
        return reports

    # ---- silver ----

    def build_silver(self, years: Iterable[int] | None = None) -> DataFrame:
        """Consolidate bronze. Only the given years are rewritten; the rest stay."""
        made_from = self.commits.latest("bronze", years)
        bronze = self.layers.read(self.layers.bronze, years)
        self.layers.write_silver(align.add_silver_audit(align.trim_strings(bronze)))
        if years is not None:
            held = {row["year"] for row in self.layers.stored_years(self.layers.bronze).collect()}
            for year in set(years) - held:
                self.layers.clear_year(self.layers.silver, year)
        self.commits.follow("silver", made_from, self.run_id)
        return self.silver()

    def years_to_consolidate(self, loaded: Iterable[int]) -> list[int]:
        """Years just loaded, and those whose bronze a broken-off run did not carry on."""
        bronze = self.layers.stored_years(self.layers.bronze)
        silver = self.layers.stored_years(self.layers.silver)
        left_over = bronze.join(silver, "year", "left_anti").collect()
        return sorted({*loaded, *(row["year"] for row in left_over), *self.commits.years_behind("silver", "bronze")})

    def silver(self) -> DataFrame:
        return self.layers.read(self.layers.silver)

    # ---- gold ----

    def build_gold(self, silver: DataFrame, years: Iterable[int] | None = None) -> list[DataFrame]:
        """Store the consolidated table and each summary. Returns the summaries' checks.

        Of the consolidated table and of the summaries' partial states only the given years are
        rewritten, all of them by default; summaries are merged from the states.
        """
        roles = self.spec.roles
        made_from = self.commits.latest("silver", years)
        changed = silver if years is None else silver.where(quoted(YEAR_PARTITION).isin(sorted(years)))
        held = {row["year"] for row in self.layers.stored_years(self.layers.silver).collect()}
        gone = set(years or ()) - held
        self.layers.write_gold_years(gold.full_consolidated(changed, roles), "full_consolidated", every=years is None, gone=gone)
        reports = []
        for output in available(silver, roles, GOLD_OUTPUTS):
            states = gold.states(changed, output.name, roles, [YEAR_PARTITION])
            path = self.layers.path("catalog", "gold_states", output.name)
            self.layers.write_years(states, path, every=years is None, gone=gone)
            merged = gold.from_states(self.layers.spark.read.parquet(path), output.name, roles)
            self.layers.write_gold(merged, output.name)
            stored = self.layers.read(self.layers.gold(output.name))
            reports.append(quality.validate_gold(stored.drop("_gold_timestamp"), output.name))
        self.commits.follow("gold", made_from, self.run_id)
        return reports

    def years_to_summarise(self, consolidated: Iterable[int]) -> list[int] | None:
        """Years just consolidated and those gold has not followed; None where gold holds nothing."""
        if not self.commits.known("gold"):
            return None
        return sorted({*consolidated, *self.commits.years_behind("gold", "silver")})

    def build_analyses(self, silver: DataFrame) -> list[str]:
        """Store every analysis the columns allow, and log which were stored.

        Outputs that only count share one stored table of counted combinations
        per set of columns; outputs derived from others read the stored ones.
        """
        roles, written, stored, counts = self.spec.roles, [], {}, {}
        for analysis in available(silver, roles, ANALYSES + REPORTS):
            source = silver
            if analysis.counts_over:
                over = analysis.counts_over
                if over not in counts:
                    path = self.layers.path("catalog", "counts", "_and_".join(over))
                    counts_for(silver, roles, over).write.mode("overwrite").parquet(path)
                    counts[over] = self.layers.spark.read.parquet(path)
                source = counts[over]
            made = analysis.make(source, roles, self.options, stored)
            self.layers.write_result(made, analysis.family, analysis.name)
            stored[analysis.name] = self.layers.read_result(analysis.family, analysis.name)
            written.append((analysis.family, analysis.name))
        done = self.layers.spark.createDataFrame(written, "family string, name string")
        done.withColumn("completed_at", F.current_timestamp()).write.mode("append").parquet(
            self.analysis_log_path
        )
        return [name for _, name in written]

    @property
    def analysis_log_path(self) -> str:
        return self.layers.path("catalog", "analysis_log")

    def completed_analyses(self) -> DataFrame:
        """(family, name, completed_at) of each analysis's latest run."""
        log = self.layers.spark.read.parquet(self.analysis_log_path)
        return log.groupBy("family", "name").agg(F.max("completed_at").alias("completed_at"))

    # ---- all of it ----

    def run(
        self,
        raw_root: str,
        paths: Mapping[int, str | Sequence[str]] | readers.Extracts | None = None,
        incremental: bool = False,
        run_analysis: bool = True,
    ) -> DataFrame:
        """Raw to gold. Incremental runs store only years whose files are new or changed or whose
        load was not finished, and end in the same tables as a full run over all files.

        Without ``paths`` all extracts below the root are loaded. Files that are none, or copies, are
        rows of the report and of the quarantine table.
        """
        if paths is None:
            paths = readers.resolve_extracts(self.layers.spark, raw_root)
        reports = []
        if isinstance(paths, readers.Extracts):
            paths.quarantined.write.mode("overwrite").parquet(self.layers.path("catalog", "quarantine"))
            reports.append(self._quarantine_rows(paths.quarantined))
            paths = paths.years
        self.catalog(raw_root)
        loaded = self.years_to_load(paths, incremental)
        reports += self.load_bronze({year: paths[year] for year in loaded})
        if not self.layers.exists(self.layers.bronze):
            # nothing was found or readable: say so, and store nothing else
            self.layers.write_report(reduce(DataFrame.unionByName, [*reports, self._nothing_stored()]))
            return self.layers.spark.createDataFrame([], self.spec.schema)
        stale = self.years_to_consolidate(loaded)
        silver = self.build_silver(stale) if stale else self.silver()
        bronze = self.layers.read(self.layers.bronze)
        fresh = self.layers.read(self.layers.bronze, stale or None)
        reports.append(quality.validate_bronze(fresh, self.spec))
        reports.append(quality.validate_silver(silver, self.spec))
        reports.append(self.conservation(bronze, silver))
        due = self.years_to_summarise(stale)
        if due is None or due:
            reports += self.build_gold(silver, due)
        if run_analysis:
            self.build_analyses(silver)
        self.layers.write_report(reduce(DataFrame.unionByName, reports))
        return silver

    @staticmethod
    def _quarantine_rows(quarantined: DataFrame) -> DataFrame:
        return quarantined.select(
            F.lit("quarantine").alias("layer"),
            F.col("relative_path").alias("scope"),
            F.lit("file_is_loaded").alias("check"),
            F.lit(quality.WARNING).alias("severity"),
            F.lit(False).alias("passed"),
            F.lit(1.0).alias("metric"),
            F.col("reason").alias("detail"),
        )

    def _nothing_stored(self) -> DataFrame:
        row = ("bronze", "all", "years_present", quality.ERROR, False, 0.0, "no extract was found or readable")
        return self.layers.spark.createDataFrame([row], quality.REPORT_SCHEMA)

    def conservation(self, bronze: DataFrame, silver: DataFrame) -> DataFrame:
        """Rows per year in bronze against silver, as report rows."""
        compared = quality.row_conservation(bronze, silver, YEAR_PARTITION)
        return compared.select(
            F.lit("silver").alias("layer"),
            quoted("year").cast("string").alias("scope"),
            F.lit("row_conservation").alias("check"),
            F.lit(quality.ERROR).alias("severity"),
            "passed",
            (F.col("rows_after") - F.col("rows_before")).cast("double").alias("metric"),
            F.lit("rows gained or lost").alias("detail"),
        )

    def run_summary(self, years: Iterable[int]) -> DataFrame:
        """Per year: whether it is stored, its file's state, and its checks."""
        spark = self.layers.spark
        wanted = spark.createDataFrame([(y,) for y in years], "year int")
        stored = self.layers.stored_years(self.layers.bronze).withColumn("ingested", F.lit(True))
        report = self.layers.read_report()
        checked = quality.scope_results(report).where(F.col("layer") == "raw").select(
            F.col("scope").cast("int").alias("year"), "errors_count", "warnings_count", "passed"
        )
        log = manifest.read_log(spark, self.log_path)
        state = manifest.latest(log).select("year", "processing_status", "error_message")
        return (
            wanted.join(stored, "year", "left")
            .join(state, "year", "left")
            .join(checked, "year", "left")
            .withColumn("ingested", F.coalesce("ingested", F.lit(False)))
        )
