"""A shareable extract of a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from strata.functions.scalars import quoted
from strata.spec import INTERNAL_PREFIX, KEPT_INTERNAL_COLUMNS, YEAR_PARTITION


def drop_internal_columns(df: DataFrame) -> DataFrame:
    internal = [
        c for c in df.columns if c.startswith(INTERNAL_PREFIX) and c not in KEPT_INTERNAL_COLUMNS
    ]
    return df.drop(*internal)


def timestamps_to_dates(df: DataFrame) -> DataFrame:
    stamps = {
        f.name for f in df.schema.fields if isinstance(f.dataType, (TimestampType, TimestampNTZType))
    }
    return df.select(
        *[F.to_date(quoted(c)).alias(c) if c in stamps else quoted(c) for c in df.columns]
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """One row of each group of equal rows; copies combine before the shuffle."""
    return df.dropDuplicates()


def refined(df: DataFrame, year: int | None = None) -> DataFrame:
    """Distinct rows without audit columns, times cut to dates; one year if given.

    The year filter is on the partition column, so only that folder is read.
    """
    if year is not None:
        df = df.where(quoted(YEAR_PARTITION) == year)
    return drop_internal_columns(timestamps_to_dates(distinct_rows(df)))


def write_refined(df: DataFrame, path: str, year: int | None = None, files: int | None = None) -> None:
    """Write the extract. ``files=1`` gives one file to hand on; it passes through
    one task, so it is for extracts small enough to share."""
    rows = refined(df, year)
    if files is not None:
        rows = rows.repartition(files)
    rows.write.mode("overwrite").option("compression", "snappy").parquet(path)
