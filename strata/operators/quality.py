"""Data-quality rules as one-pass aggregates that yield report rows.

A rule is a named aggregate (its metric) with the condition under which it
passes. All rules of a layer share one ``groupBy(scope)``; only duplicate
checks need their own shuffle. A report row is
(layer, scope, check, severity, passed, metric, detail).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from strata.functions import scalars, sqltext
from strata.functions.scalars import quoted
from strata.operators.align import match_aliases
from strata.operators.profile import duplicate_keys, duplicate_rows, missing_sql, per_column
from strata.spec import EXPECTED_EXTRAS_BY_YEAR, YEAR_PARTITION, Domain, Spec, Thresholds

ERROR = "ERROR"
WARNING = "WARNING"
INFO = "INFO"

REPORT_COLUMNS = ["layer", "scope", "check", "severity", "passed", "metric", "detail"]
REPORT_SCHEMA = (
    "layer string, scope string, `check` string, severity string, "
    "passed boolean, metric double, detail string"
)

CustomCheck = Callable[[DataFrame], Column]


@dataclass(frozen=True)
class Rule:
    """``metric`` is an aggregate, as SQL or as a Column. ``passes`` is SQL about
    the value named ``metric``."""

    name: str
    severity: str
    metric: str | Column
    passes: str = "metric = 0"
    detail: str = ""


# ---- rules ---------------------------------------------------------------


def rows_rule() -> Rule:
    return Rule("not_empty", ERROR, "count(1)", "metric > 0")


def min_rows_rule(minimum: int, severity: str) -> Rule:
    return Rule("min_rows", severity, "count(1)", f"metric >= {minimum}", f"at least {minimum} rows")


def null_rule(df: DataFrame, column: str, max_pct: float) -> Rule:
    share = f"coalesce(try_divide(count_if({missing_sql(df, column)}) * 100.0D, count(1)), 0.0D)"
    detail = f"at most {max_pct} percent"
    return Rule(f"nulls:{column}", WARNING, share, f"metric <= {max_pct}", detail)


def year_rule(column: str, expected: str) -> Rule:
    """Rows whose year is not the one their file stands for; ``expected`` is SQL."""
    year = scalars.int_sql(sqltext.name(column))
    wrong = f"count_if(NOT ({year} <=> {expected}))"
    return Rule("year_consistency", ERROR, wrong, detail="rows of another year")


def postal_code_rule(column: str) -> Rule:
    bad = f"count_if(NOT {scalars.postal_code_ok_sql(sqltext.name(column))})"
    return Rule("postal_code", WARNING, bad, detail="not eight digits")


def domain_rule(domain: Domain) -> Rule:
    allowed = ", ".join(sqltext.text(value) for value in domain.allowed)
    outside = f"count_if(upper(trim({sqltext.name(domain.column)})) NOT IN ({allowed}))"
    detail = "allowed: " + ", ".join(domain.allowed)
    return Rule(f"domain:{domain.column}", WARNING, outside, detail=detail)


def numeric_rule(df: DataFrame, column: str) -> Rule:
    """Values that cannot be read as a number."""
    value = f"CAST({sqltext.name(column)} AS STRING)"
    bad = f"count_if({value} IS NOT NULL AND {scalars.double_sql(value)} IS NULL)"
    if isinstance(df.schema[column].dataType, NumericType):
        bad = "count_if(false)"
    return Rule(f"numeric:{column}", WARNING, bad, detail="not a number")


def custom_rules(df: DataFrame, checks: dict[str, CustomCheck]) -> tuple[list[Rule], list[tuple]]:
    """Caller-given aggregates. One that cannot be planned becomes a warning row."""
    rules, failed = [], []
    for name, check in checks.items():
        try:
            metric = check(df)
            df.agg(metric)
        except (AnalysisException, TypeError, ValueError, AttributeError) as problem:
            failed.append((name, str(problem).splitlines()[0]))
        else:
            rules.append(Rule(f"custom:{name}", INFO, metric, "true"))
    return rules, failed


# ---- running -------------------------------------------------------------


def run_rules(
    df: DataFrame, rules: Sequence[Rule], layer: str, scope: Column | None = None
) -> DataFrame:
    """Report rows of all rules in one pass, per value of ``scope`` if given."""
    metrics = []
    for i, rule in enumerate(rules):
        metric = F.expr(rule.metric) if isinstance(rule.metric, str) else rule.metric
        metrics.append(metric.cast("double").alias(f"__m{i}"))
    if scope is None:
        wide = df.agg(*metrics).withColumn("scope", F.lit("all"))
    else:
        wide = df.groupBy(scope.cast("string").alias("scope")).agg(*metrics)
    rows = ", ".join(
        f"struct({sqltext.text(rule.name)} AS check, {sqltext.text(rule.severity)} AS severity, "
        f"__m{i} AS metric, {sqltext.text(rule.detail)} AS detail, "
        f"({re.sub(r'\bmetric\b', f'__m{i}', rule.passes)}) AS passed)"
        for i, rule in enumerate(rules)
    )
    report = wide.select(F.lit(layer).alias("layer"), "scope", F.expr(f"inline(array({rows}))"))
    return report.select(*REPORT_COLUMNS)


def _fixed_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, REPORT_SCHEMA)


def _metric_row(
    table: DataFrame, layer: str, check: str, severity: str, metric: str, detail: str
) -> DataFrame:
    value = F.col(metric).cast("double")
    return table.select(
        F.lit(layer).alias("layer"),
        F.lit("all").alias("scope"),
        F.lit(check).alias("check"),
        F.lit(severity).alias("severity"),
        (value == 0).alias("passed"),
        value.alias("metric"),
        F.lit(detail).alias("detail"),
    )


def check_columns(df: DataFrame, year: int, spec: Spec = Spec(), layer: str = "raw") -> DataFrame:
    """Required, missing and extra columns of one file, from its header alone.

    A missing column that a known spelling stands in for is a warning.
    """
    required, actual = spec.columns, df.columns
    expected_extra = EXPECTED_EXTRAS_BY_YEAR.get(year, ())
    internal = {c for c in actual if c.startswith("_")} - set(expected_extra)
    missing = [c for c in required if c not in actual]
    extra = [c for c in actual if c not in required and c not in expected_extra and c not in internal]
    stand_ins = {
        target: source
        for source, target in match_aliases(extra, required, spec.aliases).items()
        if target in missing
    }
    lost = [c for c in missing if c not in stand_ins]
    scope = str(year)
    rows = [
        (layer, scope, "required_columns", ERROR, not lost, float(len(lost)), ", ".join(lost)),
        (
            layer, scope, "renamed_columns", WARNING, not stand_ins, float(len(stand_ins)),
            ", ".join(f"{source} -> {target}" for target, source in stand_ins.items()),
        ),
        (layer, scope, "extra_columns", WARNING, not extra, float(len(extra)), ", ".join(extra)),
    ]
    if not actual:
        rows.append((layer, scope, "has_columns", ERROR, False, 0.0, "no columns"))
    return _fixed_rows(df, rows)


def validate_raw(df: DataFrame, year: int, spec: Spec = Spec()) -> DataFrame:
    """Checks of one year's file as read, before alignment."""
    roles, limits = spec.roles, spec.thresholds
    present = [c for c in df.columns if not c.startswith("_")]
    rules = [rows_rule(), min_rows_rule(limits.min_rows_per_year, ERROR)]
    rules += [null_rule(df, c, limits.max_null_pct) for c in present]
    if roles.year in present:
        rules.append(year_rule(roles.year, str(year)))
    if roles.postal_code in present:
        rules.append(numeric_rule(df, roles.postal_code))
    rules += [
        numeric_rule(df, f.name)
        for f in spec.schema.fields
        if f.name in present and f.name in ("numero", "Código Logradouro")
    ]
    rules += [domain_rule(d) for d in spec.domains if d.column in present]
    report = run_rules(df, rules, "raw").withColumn("scope", F.lit(str(year)))
    return report.unionByName(check_columns(df, year, spec))


def validate_bronze(df: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """Checks of the aligned table, per year."""
    limits = spec.thresholds
    columns = [c for c in df.columns if c != YEAR_PARTITION]
    rules = [rows_rule(), min_rows_rule(limits.min_rows_per_year, WARNING)]
    rules += [null_rule(df, c, limits.max_null_pct) for c in columns]
    rules.append(year_rule(spec.roles.year, YEAR_PARTITION))
    return run_rules(df, rules, "bronze", quoted(YEAR_PARTITION))


def validate_silver(
    df: DataFrame, spec: Spec = Spec(), custom: dict[str, CustomCheck] | None = None
) -> DataFrame:
    """Checks of the consolidated table: keys, years, domains, custom rules."""
    roles = spec.roles
    rules = [rows_rule()]
    if roles.year in df.columns:
        years = f"count(DISTINCT {sqltext.name(roles.year)})"
        rules.append(Rule("years_present", WARNING, years, "metric > 0"))
    if roles.postal_code in df.columns:
        rules.append(postal_code_rule(roles.postal_code))
    rules += [domain_rule(d) for d in spec.domains if d.column in df.columns]
    extra, failed = custom_rules(df, custom or {})
    report = run_rules(df, rules + extra, "silver")
    keys = [c for c in (roles.entity, roles.year) if c in df.columns]
    if keys:
        counted = duplicate_keys(df, keys)
        report = report.unionByName(
            _metric_row(counted, "silver", "unique_keys", WARNING, "duplicate_keys", "repeated keys")
        )
    if failed:
        rows = [("silver", "all", f"custom:{n}", WARNING, False, None, why) for n, why in failed]
        report = report.unionByName(_fixed_rows(df, rows))
    return report


def validate_gold(df: DataFrame, name: str, limits: Thresholds = Thresholds()) -> DataFrame:
    """Checks of one summary: not empty, few NULLs, no repeated rows."""
    layer = f"gold_{name}"
    rules = [Rule("row_count", INFO, "count(1)", "true")]
    rules += [null_rule(df, c, limits.max_gold_null_pct) for c in df.columns]
    copies = duplicate_rows(df)
    repeated = _metric_row(
        copies, layer, "no_duplicates", ERROR, "duplicate_groups", "rows that occur again"
    )
    return run_rules(df, rules, layer).unionByName(repeated)


# ---- single checks as tables ---------------------------------------------


def structure(df: DataFrame) -> DataFrame:
    """Row and column counts, and whether either is zero."""
    width = len(df.columns)
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(
        "row_count",
        F.lit(width).cast("bigint").alias("column_count"),
        ((F.col("row_count") > 0) & F.lit(width > 0)).alias("passed"),
    )


def min_rows_by_year(df: DataFrame, year: str, minimum: int) -> DataFrame:
    counted = df.groupBy(quoted(year).alias("year")).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("passed", F.col("row_count") >= minimum)


def years_present(df: DataFrame, year: str) -> DataFrame:
    """One row per year found, with its rows and the number of years."""
    counted = df.groupBy(quoted(year).alias("year")).agg(F.count(F.lit(1)).alias("row_count"))
    counted = counted.where(F.col("year").isNotNull())
    return counted.withColumn("year_count", counted.agg(F.count(F.lit(1))).scalar())


def year_consistency(df: DataFrame, year: Column, expected: Column) -> DataFrame:
    """Per expected year: rows, rows of another year, and the verdict."""
    return (
        df.groupBy(expected.alias("expected_year"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(~year.eqNullSafe(expected)).alias("wrong_year_rows"),
        )
        .withColumn("passed", F.col("wrong_year_rows") == 0)
    )


def type_checks(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Per column: declared type, expected type, and values that do not convert."""
    declared = dict(df.dtypes)
    metrics = {}
    for name, target in expected.items():
        value = f"CAST({sqltext.name(name)} AS STRING)"
        bad = f"{value} IS NOT NULL AND try_cast({value} AS {target}) IS NULL"
        metrics[name] = {
            "declared": f"any_value({sqltext.text(declared[name])})",
            "expected": f"any_value({sqltext.text(target)})",
            "failing": f"count_if({bad})",
        }
    checked = per_column(df, metrics)
    return checked.withColumn("passed", F.col("failing") == 0)


def row_conservation(before: DataFrame, after: DataFrame, year: str) -> DataFrame:
    """Rows per year on both sides of a step; passed where none were lost or added."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(quoted(year).alias("year")).agg(F.count(F.lit(1)).alias(name))

    joined = _stack_counts(counted(before, "rows_before"), counted(after, "rows_after"))
    return joined.withColumn("passed", F.col("rows_before") == F.col("rows_after"))


def _stack_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Combine two per-year counts by stacking them; no outer join to null-extend."""
    stacked = left.unionByName(right, allowMissingColumns=True)
    return stacked.groupBy("year").agg(
        F.coalesce(F.sum("rows_before"), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("rows_after"), F.lit(0)).alias("rows_after"),
    )


# ---- roll-ups ------------------------------------------------------------


def scope_results(report: DataFrame) -> DataFrame:
    """Per layer and scope: failed errors and warnings; passed when no error failed."""
    failed = ~F.col("passed")
    counted = report.groupBy("layer", "scope").agg(
        F.count_if(failed & (F.col("severity") == ERROR)).alias("errors_count"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warnings_count"),
        F.max(F.when(F.col("check") == "not_empty", F.col("metric"))).cast("bigint").alias("row_count"),
    )
    return counted.withColumn("passed", F.col("errors_count") == 0)


def summary(report: DataFrame) -> DataFrame:
    """Validations run, passed, failed and the success rate in percent."""
    results = scope_results(report).agg(
        F.count(F.lit(1)).alias("total_validations"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )
    rate = F.try_divide(F.col("passed") * 100.0, F.col("total_validations"))
    return results.withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))


def findings(report: DataFrame) -> DataFrame:
    """One row per failed check."""
    failed = report.where(~F.col("passed") & F.col("severity").isin(ERROR, WARNING))
    return failed.select("layer", "scope", "severity", "check", "metric", "detail")
