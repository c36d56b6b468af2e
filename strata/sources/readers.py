"""Raw file readers. Every cell arrives as text; alignment gives it a type.

Inferring types per file would make the same column differ between years, and
costs an extra pass over the data.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions import sqltext
from strata.sources.jsonsplit import read_records
from strata.sources.scratch import scratch_path

def read_delimited(
    spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "utf-8"
) -> DataFrame:
    """Delimited text with a header line. Files read together must share it."""
    return spark.read.csv(path, header=True, sep=sep, encoding=encoding, inferSchema=False)


def _dump_rows(records: DataFrame, names: list[str]) -> DataFrame:
    rows = records.select(F.from_json("value", "array<string>").alias("record"))
    return rows.selectExpr(
        *[f"get(record, {i}) AS {sqltext.name(name)}" for i, name in enumerate(names)]
    )


def _object_rows(records: DataFrame) -> DataFrame:
    """Objects as a table; keys and types are Spark's, from the lines as stored."""
    path = scratch_path(records, "json-lines")
    records.write.text(path, lineSep="\x1e")
    return records.sparkSession.read.json(path, lineSep="\x1e")


def read_datastore_dump(spark: SparkSession, path: str) -> DataFrame:
    """``{"fields": [{"id": ...}], "records": [[...], ...]}`` as a table, read by many tasks."""
    records, head = read_records(spark, path)
    names = [field["id"] for field in head.get("fields") or []]
    if not names:
        raise ValueError(f"no field names in {path}")
    return _dump_rows(records, names)


def read_record_json(spark: SparkSession, path: str) -> DataFrame:
    """``{"records": [{...}, ...]}`` as a table, one column per key, read by many tasks."""
    return _object_rows(read_records(spark, path)[0])


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON extract of either layout, told apart by whether it lists fields; it is read once."""
    records, head = read_records(spark, path)
    names = [field["id"] for field in head.get("fields") or []]
    return _dump_rows(records, names) if names else _object_rows(records)


def read_extract(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """One year's extract, by file ending."""
    kind = path.rsplit(".", 1)[-1].lower()
    if kind == "json":
        return read_json(spark, path)
    if kind == "parquet":
        return spark.read.parquet(path)
    return read_delimited(spark, path, sep)


def read_years(spark: SparkSession, paths: Mapping[int, str], sep: str = ";") -> dict[int, DataFrame]:
    """Lazy frames by year. Headers may differ between years, hence one reader each."""
    return {year: read_extract(spark, paths[year], sep) for year in sorted(paths)}


# Fixed value: how a year's extract is named; any year and any of the endings.
EXTRACT_NAME = r"^(?:.*/)?(iptu_([0-9]{4})(?:_json)?)\.(csv|json|parquet)$"

QUARANTINE_SCHEMA = "file_path string, relative_path string, year int, reason string"


class SeveralExtracts(ValueError):
    """A year has several extracts where one was asked for."""


@dataclass(frozen=True)
class Extracts:
    """The files of each year, and a row for every file that is none of them, with the reason."""

    years: dict[int, list[str]]
    quarantined: DataFrame

    def only(self, years: list[int]) -> Extracts:
        return Extracts({y: p for y, p in self.years.items() if y in years}, self.quarantined)


def resolve_extracts(spark: SparkSession, root: str, name: str = EXTRACT_NAME) -> Extracts:
    """All files below ``root``: each year's extracts, or quarantined.

    ``name`` matches a file's relative path; its first group is the bare name, its
    second the year. Several files of a year are its parts, and are all loaded; one whose
    content equals another's is a copy and quarantined, the one in a folder of its own name
    being kept. The listing is read, and the content of files only in years with several.
    """
    from strata.sources import manifest

    path = F.col("relative_path")
    bare, folder = F.regexp_extract(path, name, 1), F.element_at(F.split(F.concat(F.lit("/"), path), "/"), -2)
    listed = manifest.scan(spark, root, checksum=False, pattern="*").select(
        "file_path",
        "relative_path",
        F.when(path.rlike(name), F.regexp_extract(path, name, 2)).cast("int").alias("year"),
        (folder != bare).alias("elsewhere"),
    )
    files = listed.orderBy("year", "elsewhere", "file_path").collect()
    several = {f["year"] for f in files if sum(g["year"] == f["year"] for g in files) > 1} - {None}
    sums: dict[str, str] = {}
    if several:
        known = manifest.scan(spark, root).where(path.rlike(name))
        own = known.where(F.regexp_extract(path, name, 2).cast("int").isin(sorted(several)))
        sums = {row["file_path"]: row["md5_checksum"] for row in own.select("file_path", "md5_checksum").collect()}
    years: dict[int, list[str]] = {}
    aside, first = [], {}
    for file in files:
        where, year = file["file_path"], file["year"]
        if year is None:
            aside.append((where, file["relative_path"], None, "not named like an extract"))
            continue
        kept = first.setdefault((year, sums.get(where, where)), where)
        if kept == where:
            years.setdefault(year, []).append(where)
        else:
            aside.append((where, file["relative_path"], year, f"same content as {kept}"))
    return Extracts(years, spark.createDataFrame(aside, QUARANTINE_SCHEMA))


def find_extracts(spark: SparkSession, root: str, name: str = EXTRACT_NAME) -> dict[int, str]:
    """One path for each year, for callers that take no more: the only extract, or the only
    one in a folder of its own name.

    Where neither holds, ``SeveralExtracts`` stops this; ``resolve_extracts`` gives all files.
    """
    chosen = {}
    for year, paths in sorted(resolve_extracts(spark, root, name).years.items()):
        own = [p for p in paths if p.split("/")[-2] == p.split("/")[-1].rsplit(".", 1)[0]]
        if len(paths) > 1 and len(own) != 1:
            raise SeveralExtracts(f"several extracts of {year}: {', '.join(paths)}")
        chosen[year] = own[0] if len(paths) > 1 else paths[0]
    return chosen
