"""Exact percentiles of groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one task's
memory, which a year holding a third of a 100 TB table does not survive. Here:

1. ``percentile_approx`` gives, per group, a value just below and just above
   each wanted rank. The sketch has a fixed size and combines map-side.
2. One more pass counts rows: a value inside such an interval keeps its own
   count, all values of the gap between two intervals share one count (with
   the gap's least and greatest value). Both combine map-side, so what is
   shuffled is a sliver of the group.
3. The sliver is selected from, not sorted whole: an interval is cut into 4,096 digits, whose
   counts (a bounded number for a group, whatever its size) tell in which digit a wanted rank
   lies; running counts are then taken inside those digits only.

The counts are exact, so the result is. The sketch's error bound only decides
how thin the sliver is; a rank it failed to enclose stops the job rather than
giving a wrong answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions import sqltext
from strata.functions.scalars import quoted
from strata.operators.small_side import compute_once, null_safe_join

SKETCH_ACCURACY = 10_000
#: Parts of an interval whose counts are kept apart.
DIGITS = 4_096


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probabilities: Sequence[float],
    names: Sequence[str],
    along: Mapping[str, str] | None = None,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row per group: ``keys``, the ``along`` aggregates, and one interpolated
    percentile per name.

    ``along`` holds further aggregates of ``df`` by name, as SQL, in which
    ``__v`` is the value; they are computed in the sketch pass, so they cost no
    scan of their own. NULL values have no rank; a group without any other
    value has NULL percentiles. The sketch pass runs at once.
    """
    keys, along = list(keys), dict(along or {})
    if keys:
        rows, groups = sketched(df, keys, value, probabilities, along, accuracy)
        return finished(rows, groups, keys, probabilities, names, along)
    rows = df.withColumn("__v", value.cast("double"))
    sketch = _sketch(rows, [], probabilities, along, accuracy)
    values = rows.select("__v").where("__v IS NOT NULL")
    constants = _constants(sketch)
    picked = _pick_ranks(
        _count_by_slot(values.select("__v", *constants), [], len(names)), [], probabilities, names
    )
    known = [c for c, (name, _) in zip(constants, sketch.dtypes) if name in along]
    return picked.select(*known, *[quoted(name) for name in names])


def sketched(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probabilities: Sequence[float],
    along: Mapping[str, str],
    accuracy: int = SKETCH_ACCURACY,
) -> tuple[DataFrame, DataFrame]:
    """The rows with ``__v``, and the groups' sketches and ``along`` aggregates, computed once."""
    rows = df.withColumn("__v", value.cast("double"))
    return rows, compute_once(_sketch(rows, [sqltext.name(key) for key in keys], probabilities, along, accuracy))


def finished(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    probabilities: Sequence[float],
    names: Sequence[str],
    along: Mapping[str, str],
) -> DataFrame:
    """The result of ``exact_percentiles`` from what ``sketched`` gave."""
    keys, columns = list(keys), [sqltext.name(key) for key in keys]
    values = rows.selectExpr(*columns, "__v").where("__v IS NOT NULL")
    bounds = [c for c in groups.columns if c not in along]
    located = null_safe_join(values, groups.select(*[quoted(c) for c in bounds]), keys, "inner")
    picked = _pick_ranks(
        _count_by_slot(located, columns, len(names)), columns, probabilities, names
    )
    return null_safe_join(groups.selectExpr(*columns, *[sqltext.name(a) for a in along]), picked, keys, "left")


def exact_medians(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    return exact_percentiles(df, keys, value, [0.5], [name])


def _number(value: float) -> str:
    return f"double('{value!r}')"


def _apart(marks: Sequence[float]) -> list[tuple[float, float]]:
    """The (from, to) pairs as intervals that do not overlap."""
    merged: list[tuple[float, float]] = []
    for low, high in zip(marks[::2], marks[1::2]):
        if merged and low <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(merged[-1][1], high)
        else:
            merged.append((low, high))
    return merged


def percentiles_of_columns(
    df: DataFrame,
    values: Mapping[str, str],
    probabilities: Sequence[float],
    names: Sequence[str],
    along: Mapping[str, str],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """One row for each named value (name to SQL): ``column``, the ``along`` aggregates of its
    ``__v``, and one exact percentile per name.

    A row of the table stays one row: sketches and gaps of all columns are one wide aggregation each, and only values
    inside an interval become rows of their own. The sketch pass runs at once.
    """
    spark = df.sparkSession
    rows = df.selectExpr(*[f"{sql} AS __v{i}" for i, sql in enumerate(values.values())])
    slack = 3.0 / accuracy
    marks = ", ".join(f"{m!r}D" for p in probabilities for m in (max(p - slack, 0.0), min(p + slack, 1.0)))
    sketches = []
    for i in range(len(values)):
        sketches += [f"count(__v{i}) AS __rows_{i}", f"percentile_approx(__v{i}, array({marks}), {accuracy}) AS __marks_{i}"]
        sketches += [f"{sql.replace('__v', f'__v{i}')} AS __{n}_{i}" for n, sql in enumerate(along.values())]
    sketched = rows.agg(*[F.expr(sql) for sql in sketches])
    seen = sketched.first()
    kinds = dict(sketched.dtypes)
    schema = ", ".join(["column string", *[f"{sqltext.name(a)} {kinds[f'__{n}_0']}" for n, a in enumerate(along)]]) if values else "column string"
    groups = spark.createDataFrame([(c, *[seen[f"__{n}_{i}"] for n in range(len(along))]) for i, c in enumerate(values)], schema)
    gaps, copies, gap_figures = [], [], []
    for i, column in enumerate(values):
        if not seen[f"__rows_{i}"]:
            continue
        apart = _apart(seen[f"__marks_{i}"])
        head = f"{sqltext.text(column)} AS column, {seen[f'__rows_{i}']}L AS __rows"
        cases = []
        for j, (low, high) in enumerate(apart):
            digit = _digit(f"__v{i}", _number(low), _number(high), j)
            cases.append(f"WHEN __v{i} BETWEEN {_number(low)} AND {_number(high)} THEN struct({head}, __v{i} AS __own, {digit} AS __digit)")
        copies.append(f"CASE {' '.join(cases)} END")
        ends = [None, *[high for _, high in apart]], [*[low for low, _ in apart], None]
        for j, (after, before) in enumerate(zip(*ends)):
            bounds = [f"__v{i} > {_number(after)}"] * (after is not None) + [f"__v{i} < {_number(before)}"] * (before is not None)
            own = f"CASE WHEN {' AND '.join(bounds)} THEN __v{i} END"
            gap_figures += [f"count({own}) AS __n_{i}_{j}", f"min({own}) AS __low_{i}_{j}", f"max({own}) AS __high_{i}_{j}"]
            gaps.append(f"struct({head}, CAST(NULL AS DOUBLE) AS __own, {-1 - j} AS __digit, __n_{i}_{j} AS __n, __low_{i}_{j} AS __low, __high_{i}_{j} AS __high)")
    if not copies:
        return groups.select("*", *[F.lit(None).cast("double").alias(n) for n in names])
    inside = rows.selectExpr(f"inline(array_compact(array({', '.join(copies)})))")
    own = inside.groupBy("column", "__rows", "__own", "__digit").agg(F.expr("count(1) AS __n"))
    held = own.selectExpr("*", "__own AS __low", "__own AS __high")
    between = rows.agg(*[F.expr(sql) for sql in gap_figures]).selectExpr(f"inline(array({', '.join(gaps)}))").where("__n > 0")
    picked = _pick_ranks(held.unionByName(between), ["`column`"], probabilities, names)
    return groups.join(picked, "column", "left").select("column", *[quoted(a) for a in along], *[quoted(n) for n in names])


def _sketch(
    rows: DataFrame,
    columns: list[str],
    probabilities: Sequence[float],
    along: Mapping[str, str],
    accuracy: int,
) -> DataFrame:
    """Per group: number of values, the ``along`` aggregates, and a (from, to) pair
    of values around each rank."""
    slack = 3.0 / accuracy
    marks = []
    for p in probabilities:
        marks += [max(p - slack, 0.0), min(p + slack, 1.0)]
    grouped = rows.groupBy(*columns).agg(
        F.count("__v").alias("__rows"),
        F.percentile_approx("__v", marks, accuracy).alias("__marks"),
        *[sqltext.expr(sql, name) for name, sql in along.items()],
    )
    bounds = []
    for i in range(len(probabilities)):
        bounds += [f"__marks[{2 * i}] AS __from_{i}", f"__marks[{2 * i + 1}] AS __to_{i}"]
    extra = [sqltext.name(name) for name in along]
    return grouped.selectExpr(*columns, "__rows", *bounds, *extra)


def _constants(sketched: DataFrame) -> list[Column]:
    """The one row of an ungrouped sketch as literals."""
    row = sketched.first()
    return [F.lit(row[name]).cast(kind).alias(name) for name, kind in sketched.dtypes]


def _digit(value: str, low: str, high: str, number: int) -> str:
    """The part of the interval that the value lies in, apart from those of other intervals."""
    # no number where an end is infinite; then the interval has one part
    part = f"coalesce(nanvl(({value} - {low}) / nullif({high} - {low}, 0), 0), 0)"
    return f"{number * DIGITS} + CAST(floor(least(greatest({part}, 0), 1) * {DIGITS - 1}) AS INT)"


def _count_by_slot(located: DataFrame, columns: list[str], count: int) -> DataFrame:
    """Count rows per slot: a single value inside an interval, or a gap.

    ``__digit`` orders a group's slots coarsely: gaps and the intervals' parts lie apart from each other.
    """
    inside = " OR ".join(f"__v BETWEEN __from_{i} AND __to_{i}" for i in range(count))
    passed = " + ".join(f"CAST(__v > __to_{i} AS INT)" for i in range(count))
    cases = [
        f"WHEN __v BETWEEN __from_{i} AND __to_{i} THEN {_digit('__v', f'__from_{i}', f'__to_{i}', i)}" for i in range(count)
    ]
    slots = located.selectExpr(
        *columns,
        "__rows",
        "__v",
        f"CASE WHEN {inside} THEN __v END AS __own",
        f"CASE {' '.join(cases)} ELSE -1 - ({passed}) END AS __digit",
    )
    return slots.groupBy(*columns, "__rows", "__own", "__digit").agg(
        F.expr("count(1) AS __n"), F.expr("min(__v) AS __low"), F.expr("max(__v) AS __high")
    )


def _pick_ranks(
    counted: DataFrame, columns: list[str], probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    within = f"PARTITION BY {', '.join(columns)} " if columns else ""
    digits = counted.groupBy(*columns, "__rows", "__digit").agg(F.expr("sum(__n) AS __n"), F.expr("min(__low) AS __low"))
    # Ranks count from zero. The digits before one hold the ranks below __base.
    placed = digits.selectExpr(
        *columns, "__rows", "__digit", "__n", f"sum(__n) OVER ({within}ORDER BY __low ROWS UNBOUNDED PRECEDING) - __n AS __base"
    )
    positions = [f"({float(p)!r}D * (__rows - 1))" for p in probabilities]
    wanted = " OR ".join(f"{end}({at}) BETWEEN __base AND __base + __n - 1" for at in positions for end in ("floor", "ceil"))
    chosen = placed.where(wanted).drop("__n", "__rows")
    slots = null_safe_join(counted, chosen, [*[c[1:-1].replace("``", "`") for c in columns], "__digit"], "inner")
    # Inside a digit, a slot covers the ranks __first..__last.
    parted = ", ".join([*columns, "__digit"])
    running = f"__base + sum(__n) OVER (PARTITION BY {parted} ORDER BY __low ROWS UNBOUNDED PRECEDING) - 1 AS __last"
    named = [f"{at} AS __at_{i}" for i, at in enumerate(positions)]
    ranked = slots.selectExpr(*columns, "__n", "__low", "__high", running, *named)
    picks, between = [], []
    for i, name in enumerate(names):
        picks += [
            f"max({_value_at(f'floor(__at_{i})')}) AS __floor_{i}",
            f"max({_value_at(f'ceil(__at_{i})')}) AS __ceil_{i}",
            f"first(__at_{i} - floor(__at_{i})) AS __part_{i}",
        ]
        between.append(
            f"__floor_{i} + (__ceil_{i} - __floor_{i}) * __part_{i} AS {sqltext.name(name)}"
        )
    picked = ranked.groupBy(*columns).agg(*[F.expr(pick) for pick in picks])
    return picked.selectExpr(*columns, *between)


def _value_at(rank: str) -> str:
    """The value at ``rank`` if this slot covers it, else NULL."""
    first = "(__last - __n + 1)"
    return f"""CASE WHEN {rank} BETWEEN {first} AND __last THEN CASE
        WHEN {rank} = {first} OR __low = __high THEN __low
        WHEN {rank} = __last THEN __high
        ELSE raise_error('percentile rank outside its interval; raise accuracy') END END"""
