"""Bring one year's raw frame to the canonical schema, and join the years.

Names are decided on the driver (a few dozen strings); the data moves through
one ``select`` per step, which Catalyst collapses into a single projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from difflib import SequenceMatcher
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, DateType, DoubleType, IntegerType, StringType, StructType

from strata.functions import scalars, sqltext
from strata.functions.scalars import quoted
from strata.operators.small_side import keep_new_keys
from strata.spec import KNOWN_ALIASES, ROLES, YEAR_PARTITION, Spec

ALIAS_SIMILARITY = 0.9
NAME_SIMILARITY = 0.7


class SchemaError(ValueError):
    """A frame's columns do not allow the requested step."""


# ---- names ---------------------------------------------------------------


def name_similarity(left: str, right: str) -> float:
    """Share of characters two names have in common, in order, ignoring case."""
    return SequenceMatcher(None, left.lower(), right.lower()).ratio()


def _plain(name: str) -> str:
    return name.strip().lower()


def assign_names(
    sources: Iterable[str], spellings: Mapping[str, Iterable[str]], threshold: float
) -> dict[str, tuple[str, float]]:
    """Source -> (target, score), best pairs first; no source or target is used twice.

    A pair's score is that of the target's most similar spelling. Equal scores are
    taken in the order of the names, so the result depends on no column order.
    """
    pairs = []
    for source in set(sources):
        for target, spelled in spellings.items():
            score = max((name_similarity(_plain(source), _plain(s)) for s in spelled), default=0.0)
            if score >= threshold:
                pairs.append((-score, source, target))
    given: dict[str, tuple[str, float]] = {}
    taken: set[str] = set()
    for score, source, target in sorted(pairs):
        if source not in given and target not in taken:
            given[source] = (target, -score)
            taken.add(target)
    return given


def _aliases_by_target(targets: Iterable[str], aliases: Mapping[str, str]) -> dict[str, list[str]]:
    return {t: [a for a, named in aliases.items() if _plain(named) == _plain(t)] for t in targets}


def match_aliases(
    sources: Sequence[str], targets: Sequence[str], aliases: Mapping[str, str] = KNOWN_ALIASES
) -> dict[str, str]:
    """Source column -> canonical column, for (nearly) the spellings in ``aliases``."""
    found = assign_names(sources, _aliases_by_target(targets, aliases), ALIAS_SIMILARITY)
    return {source: target for source, (target, _) in found.items()}


def match_similar_names(
    sources: Sequence[str],
    targets: Sequence[str],
    threshold: float = NAME_SIMILARITY,
    aliases: Mapping[str, str] | None = None,
) -> dict[str, tuple[str, float]]:
    """Source column -> (target, score) for names that are alike; aliases count as names.

    Sources that plainly are a target, and the targets they are, take no part.
    """
    plain_sources, plain_targets = {_plain(s) for s in sources}, {_plain(t) for t in targets}
    listed = _aliases_by_target(targets, aliases or {})
    spellings = {t: [t, *listed[t]] for t in targets if _plain(t) not in plain_sources}
    return assign_names([s for s in sources if _plain(s) not in plain_targets], spellings, threshold)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    present = {old: new for old, new in names.items() if old in df.columns and old != new}
    return df.withColumnsRenamed(present) if present else df


def require_unique_columns(df: DataFrame) -> DataFrame:
    repeated = sorted({name for name in df.columns if df.columns.count(name) > 1})
    if repeated:
        raise SchemaError(f"duplicate columns: {repeated}")
    return df


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {missing}")
    return df


# ---- steps ---------------------------------------------------------------


def rename_for_year(df: DataFrame, year: int, spec: Spec = Spec()) -> DataFrame:
    return rename_columns(df, spec.renames_by_year.get(year, {}))


def align_aliases(df: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """Rename known spellings, where the canonical column is missing."""
    canonical = spec.columns
    found = match_aliases(df.columns, canonical, spec.aliases)
    usable = {
        source: target
        for source, target in found.items()
        if target not in df.columns and source not in canonical
    }
    return rename_columns(df, usable)


def fill_missing(df: DataFrame, schema: StructType) -> DataFrame:
    """Canonical columns first, absent ones as typed NULLs; extra columns stay."""
    present = set(df.columns)
    known = [
        sqltext.name(f.name)
        if f.name in present
        else f"CAST(NULL AS {f.dataType.simpleString()}) AS {sqltext.name(f.name)}"
        for f in schema.fields
    ]
    extra = [sqltext.name(c) for c in df.columns if c not in schema.fieldNames()]
    return df.selectExpr(*known, *extra)


def cast_canonical(df: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """Every canonical column to its type; unreadable text becomes NULL.

    Extra columns become text, since files of other years may hold them in other types.
    """
    targets = {f.name: f.dataType for f in spec.schema.fields}
    columns = []
    for column in df.columns:
        name = sqltext.name(column)
        if column in targets:
            name = f"{_typed_sql(df, column, targets[column], spec)} AS {name}"
        elif not isinstance(df.schema[column].dataType, StringType):
            name = f"CAST({name} AS STRING) AS {name}"
        columns.append(name)
    return df.selectExpr(*columns)


def _typed_sql(df: DataFrame, name: str, target: DataType, spec: Spec) -> str:
    value = sqltext.name(name)
    if name == spec.roles.postal_code:
        return scalars.postal_code_sql(value)
    if df.schema[name].dataType == target:
        return value
    if isinstance(target, DoubleType):
        return scalars.measure_sql(df, name)
    if isinstance(target, IntegerType):
        return scalars.whole_number_sql(df, name)
    if isinstance(target, DateType):
        return scalars.registration_date_sql(df, name)
    return f"CAST({value} AS {target.simpleString()})"


def trim_strings(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        name = sqltext.name(field.name)
        columns.append(
            f"trim({name}) AS {name}" if isinstance(field.dataType, StringType) else name
        )
    return df.selectExpr(*columns)


def align_year(df: DataFrame, year: int, spec: Spec = Spec()) -> DataFrame:
    """All steps for one year's raw frame: names, missing columns, types, blanks."""
    require_unique_columns(df)
    named = align_aliases(rename_for_year(df, year, spec), spec)
    return trim_strings(cast_canonical(fill_missing(named, spec.schema), spec))


def add_bronze_audit(df: DataFrame, year: int, source_file: Column | str) -> DataFrame:
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.withColumns(
        {
            "_bronze_ingestion_timestamp": F.current_timestamp(),
            "_source_file": source,
            YEAR_PARTITION: F.lit(year),
            "_data_layer": F.lit("bronze"),
        }
    )


def add_silver_audit(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"_silver_timestamp": F.current_timestamp(), "_data_layer": F.lit("silver")}
    )


def union_years(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column absent from a frame is NULL for its rows.

    The frames should be aligned first: equal types keep the union from
    widening a column and then failing on a value it cannot convert.
    """
    if not frames:
        raise SchemaError("no frames to union")
    for frame in frames:
        require_unique_columns(frame)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_years(stored: DataFrame, incoming: DataFrame, key: str = ROLES.year) -> DataFrame:
    """Stored rows plus those incoming rows whose year is not stored yet."""
    return union_years([stored, keep_new_keys(incoming, stored, key)])


# ---- fuzzy values --------------------------------------------------------

# From this similarity on, two texts share a pair of neighbouring characters.
SHARED_PAIR_SIMILARITY = 0.5
_MILLION = 1_000_000
_LAST_PLACE = 2**31 - 1


def text_similarity(left: Column, right: Column) -> Column:
    """1 minus the edit distance over the longer length; 1 for two empty texts."""
    longer = F.greatest(F.length(left), F.length(right))
    return F.lit(1.0) - F.levenshtein(left, right) / F.greatest(longer, F.lit(1))


def _character_pairs(text: Column) -> Column:
    """The distinct pairs of neighbours in a text with a mark before and after it."""
    padded = F.concat(F.lit("\x02"), text, F.lit("\x03"))
    return F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2)))
    )


def _pairs_of(text: str) -> set[str]:
    """The same of a reference value."""
    padded = f"\x02{text}\x03"
    return {padded[i : i + 2] for i in range(len(padded) - 1)}


def _local(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    fields = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    made = pa.table([pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, fields)], names=fields.names)
    return spark.createDataFrame(made, fields)


def canonicalize_values(
    df: DataFrame, column: str, reference: Sequence[str], threshold: float = NAME_SIMILARITY
) -> DataFrame:
    """Map each value to its most similar reference value, at or above ``threshold``.

    Distinct values meet only the references they share two neighbouring characters
    with. A text of n characters, marked at both ends, has n + 1 such pairs and an edit
    spoils two at most, so at a similarity of 0.5 or more nothing is missed; lower
    thresholds are refused. Ties go to the earlier reference.
    Output: value, rows, canonical (NULL when nothing is close), score.
    """
    if threshold < SHARED_PAIR_SIMILARITY:
        raise SchemaError(f"thresholds go from {SHARED_PAIR_SIMILARITY} on, got {threshold}")
    spark = df.sparkSession
    rows = [(i, text, text.strip().lower()) for i, text in enumerate(reference)]
    # local tables, of exactly known size, so that values stay where they are
    listed = _local(spark, rows, "place int, canonical string, spelled string")
    paired = _local(spark, [(pair, i) for i, _, text in rows for pair in sorted(_pairs_of(text))], "pair string, place int")
    plain = F.lower(F.trim(F.col("value")))
    counted = df.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    pairs = counted.select("value", "rows", F.explode_outer(_character_pairs(plain)).alias("pair"))
    met = pairs.join(paired, "pair", "left").select("value", "rows", "place").distinct()
    score = F.round(text_similarity(plain, F.col("spelled")) * _MILLION).cast("long")
    # one number, since a greatest struct would be sorted for: score first, then the earlier reference
    mark = score * (_LAST_PLACE + 1) + (F.lit(_LAST_PLACE) - F.col("place"))
    best = met.join(listed, "place", "left").groupBy("value", "rows").agg(F.max(mark).alias("best"))
    best = best.withColumn("score", F.shiftright("best", 31) / F.lit(float(_MILLION)))
    place = F.lit(_LAST_PLACE) - F.col("best").bitwiseAND(F.lit(_LAST_PLACE))
    found = best.withColumn("place", F.when(F.col("score") >= threshold, place).cast("int"))
    return found.join(listed, "place", "left").select(
        "value", "rows", "canonical", F.when(F.col("place").isNotNull(), F.col("score")).alias("score")
    )


def canonicalize_column(
    df: DataFrame, column: str, reference: Sequence[str], threshold: float = NAME_SIMILARITY
) -> DataFrame:
    """Rows with ``column`` replaced by its canonical value where there is one."""
    known = canonicalize_values(df, column, reference, threshold).where("canonical IS NOT NULL")
    found = df.join(known.select(F.col("value").alias("__value"), "canonical"), quoted(column) == F.col("__value"), "left")
    replaced = F.coalesce(F.col("canonical"), quoted(column)).alias(column)
    return found.select(*[replaced if c == column else quoted(c) for c in df.columns])
