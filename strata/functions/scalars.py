"""Column-to-column functions: lenient parsing, age bands, shares and growth.

Spark 4 runs in ANSI mode, where a plain cast of dirty text fails the job;
every parse here yields NULL for text it cannot read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, NumericType

from strata.functions import sqltext
from strata.spec import AGE_BANDS_7, REGISTRATION_DATE_FORMAT


def quoted(name: str) -> Column:
    """A column by exact name, whatever spaces, dots or slashes the name holds."""
    return F.col(sqltext.name(name))


# The parsers exist as SQL text, taking and giving expressions, for use over
# many columns at once; the functions below them take a column name.


def double_sql(value: str) -> str:
    return f"try_cast({value} AS DOUBLE)"


def int_sql(value: str) -> str:
    return f"try_cast({double_sql(value)} AS INT)"


def without_nan_sql(value: str) -> str:
    return f"nullif({value}, double('NaN'))"


def currency_sql(value: str) -> str:
    bare = f"trim(replace(replace(CAST({value} AS STRING), ',', '.'), 'R$', ''))"
    return without_nan_sql(double_sql(bare))


def date_sql(value: str) -> str:
    known = sqltext.text(REGISTRATION_DATE_FORMAT)
    return (
        f"to_date(coalesce(try_to_timestamp({value}, {known}), try_to_timestamp({value})))"
    )


def postal_code_sql(value: str) -> str:
    code = f"trim(CAST({value} AS STRING))"
    return f"CASE WHEN {code} RLIKE '^[0-9]{{1,7}}$' THEN lpad({code}, 8, '0') ELSE {code} END"


def postal_code_ok_sql(value: str) -> str:
    return f"({value} IS NULL OR CAST({value} AS STRING) RLIKE '^[0-9]{{8}}$')"


def measure_sql(df: DataFrame, name: str) -> str:
    value = sqltext.name(name)
    if isinstance(df.schema[name].dataType, NumericType):
        return without_nan_sql(f"CAST({value} AS DOUBLE)")
    return currency_sql(value)


def whole_number_sql(df: DataFrame, name: str) -> str:
    value = sqltext.name(name)
    if df.schema[name].dataType.typeName() in ("integer", "short", "byte"):
        return f"CAST({value} AS INT)"
    return int_sql(value)


def registration_date_sql(df: DataFrame, name: str) -> str:
    value = sqltext.name(name)
    if isinstance(df.schema[name].dataType, DateType):
        return value
    return date_sql(f"CAST({value} AS STRING)")


def lenient_double(name: str) -> Column:
    return F.expr(double_sql(sqltext.name(name)))


def lenient_int(name: str) -> Column:
    """Whole number; text such as ``1985.0`` counts as 1985."""
    return F.expr(int_sql(sqltext.name(name)))


def parse_currency(name: str) -> Column:
    """``R$ 1234,56`` to 1234.56. A NaN is as unusable as an unreadable value."""
    return F.expr(currency_sql(sqltext.name(name)))


def measure(df: DataFrame, name: str) -> Column:
    """A money or area column as DOUBLE: parsed when text, read as it is when numeric."""
    return F.expr(measure_sql(df, name))


def whole_number(df: DataFrame, name: str) -> Column:
    """An INT column, parsed leniently unless it is numeric already."""
    return F.expr(whole_number_sql(df, name))


def parse_registration_date(name: str) -> Column:
    """Date of ``2020/1/5 00:00:00.000000000`` (fraction optional) or of an ISO stamp."""
    return F.expr(date_sql(sqltext.name(name)))


def postal_code(name: str) -> Column:
    """Digits left-padded to eight places; anything else is kept for the checks to find."""
    return F.expr(postal_code_sql(sqltext.name(name)))


def is_postal_code_ok(name: str) -> Column:
    """Eight digits, or no value at all."""
    return F.expr(postal_code_ok_sql(sqltext.name(name)))


def age_in_years(built_year: Column, reference_year: int) -> Column:
    return F.lit(reference_year) - built_year


def is_valid_built_year(built_year: Column, reference_year: int) -> Column:
    return built_year.isNotNull() & (built_year > 0) & (built_year <= reference_year)


def age_band(
    age: Column, bands: Sequence[tuple[int | None, str]] = AGE_BANDS_7, right_closed: bool = True
) -> Column:
    """Label of the band holding ``age``.

    With ``right_closed`` an age of 10 is in ``0-10``, as the label says;
    otherwise it falls in the next band.
    """
    return _first_band(age, [(upper, F.lit(label)) for upper, label in bands], right_closed)


def age_band_ordinal(label: Column, bands: Sequence[tuple[int | None, str]] = AGE_BANDS_7) -> Column:
    """Position of a band label, for ordering bands by age instead of by text."""
    labels = F.array(*[F.lit(text) for _, text in bands])
    return F.array_position(labels, label).cast("int")


def _first_band(age: Column, bands, right_closed: bool) -> Column:
    chain = None
    for upper, result in bands:
        if upper is None:
            return chain.otherwise(result)
        inside = age <= upper if right_closed else age < upper
        chain = F.when(inside, result) if chain is None else chain.when(inside, result)
    return chain


def share_pct(part: Column, total: Column) -> Column:
    """Percentage of a total, two decimals; NULL when the total is zero."""
    return F.round(F.try_divide(part, total) * 100, 2)


def growth_pct(initial: Column, final: Column) -> Column:
    """Percent change; NULL when there is nothing to grow from."""
    return F.try_divide(final - initial, initial) * 100


def year_in_name(path: Column, name: Column) -> Column:
    """Smallest year (1900 to 2099, no digit beside it) in a file name, else in its path."""

    def smallest(text: Column) -> Column:
        return F.array_min(F.regexp_extract_all(text, F.lit("(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])"), F.lit(1)))

    return F.coalesce(smallest(name), smallest(path)).cast("int")
