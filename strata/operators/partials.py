"""Partial states: sums, counts, least and greatest values that can be merged.

A state table stands for records: each row holds, for the records of one combination of its keys, how
many there are and the state of each measure. States of parts merge to states of the whole, so
records can be aggregated before a join that only adds columns to them, and the states of a year can be kept and
merged with those of other years.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions.scalars import measure, quoted
from strata.operators.counting import ROWS, row_count

_SUM, _COUNT, _LEAST, _GREATEST = "__sum_", "__count_", "__least_", "__greatest_"

#: How an output follows from the merged states of its measure.
KINDS = ("rows", "count", "sum", "avg", "min", "max")

Outputs = Mapping[str, tuple[str, str | None]]


def is_states(df: DataFrame, column: str) -> bool:
    """Whether ``df`` holds states of the measure instead of its values."""
    return _SUM + column in df.columns


def has(df: DataFrame, column: str) -> bool:
    return column in df.columns or is_states(df, column)


def _merging(df: DataFrame, column: str) -> list[Column]:
    """State aggregates of a measure, from values or from states."""
    if is_states(df, column):
        return [
            F.sum(quoted(_SUM + column)).alias(_SUM + column),
            F.sum(quoted(_COUNT + column)).alias(_COUNT + column),
            F.min(quoted(_LEAST + column)).alias(_LEAST + column),
            F.max(quoted(_GREATEST + column)).alias(_GREATEST + column),
        ]
    value = measure(df, column)
    return [
        F.sum(value).alias(_SUM + column),
        F.count(value).alias(_COUNT + column),
        F.min(value).alias(_LEAST + column),
        F.max(value).alias(_GREATEST + column),
    ]


def states(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row of states for each combination of ``keys``. ``df`` may hold states already."""
    columns = [*keys, *[c for m in measures for c in ([m] if m in df.columns else [p + m for p in (_SUM, _COUNT, _LEAST, _GREATEST)])]]
    kept = [*columns, *([ROWS] if ROWS in df.columns else [])]
    rows = df.select(*[quoted(c) for c in dict.fromkeys(kept)])
    merged = [state for m in measures for state in _merging(rows, m)]
    return rows.groupBy(*[quoted(k) for k in keys]).agg(row_count(rows).alias(ROWS), *merged)


def output(kind: str, column: str | None) -> Column:
    """An aggregate over state rows."""
    if kind == "rows":
        return F.coalesce(F.sum(ROWS), F.lit(0))
    total, count = F.sum(quoted(f"{_SUM}{column}")), F.sum(quoted(f"{_COUNT}{column}"))
    if kind == "avg":
        # a group without values has no mean
        return F.when(count > 0, total.cast("double") / count)
    return {
        "sum": total,
        "count": F.coalesce(count, F.lit(0)),
        "min": F.min(quoted(f"{_LEAST}{column}")),
        "max": F.max(quoted(f"{_GREATEST}{column}")),
    }[kind]


def merged(df: DataFrame, keys: Sequence[str] | Mapping[str, str], outputs: Outputs) -> DataFrame:
    """The outputs by ``keys`` (output name to column, or names), from states."""
    named = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    grouped = df.groupBy(*[quoted(source).alias(out) for out, source in named.items()])
    return grouped.agg(*[output(*of).alias(name) for name, of in outputs.items()])


def summary(df: DataFrame, keys: Sequence[str], outputs: Outputs) -> DataFrame:
    """The outputs by ``keys`` from values or from states, in one aggregation either way."""
    measures = list(dict.fromkeys(column for _, column in outputs.values() if column))
    if all(is_states(df, m) for m in measures) and ROWS in df.columns:
        return merged(df, keys, outputs)
    rows = df.select(*[quoted(k) for k in keys], *[measure(df, m).alias(m) for m in measures if m not in keys])
    direct = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}
    aggregates = [
        (row_count(rows) if kind == "rows" else direct[kind](quoted(column))).alias(name)
        for name, (kind, column) in outputs.items()
    ]
    return rows.groupBy(*[quoted(k) for k in keys]).agg(*aggregates)
