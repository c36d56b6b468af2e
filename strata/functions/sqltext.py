"""Quoting for expressions written as SQL text.

Wide tables need hundreds of expressions; one ``F.expr`` is one call to the
JVM where the same expression built call by call is dozens.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def name(column: str) -> str:
    """A column by exact name, whatever spaces, dots or slashes it holds."""
    return "`" + column.replace("`", "``") + "`"


def names(columns: Iterable[str]) -> str:
    return ", ".join(name(c) for c in columns)


def text(value: str | None) -> str:
    """A string literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def expr(sql: str, alias: str | None = None) -> Column:
    return F.expr(sql if alias is None else f"{sql} AS {name(alias)}")
