"""Named analyses: what each is called, what it needs, and how it is built.

A builder is a pure DataFrame-to-DataFrame function. Analyses whose columns
are absent are skipped, so a partial table still yields what it can.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from strata.operators import age, evolution, gold, reshape, value, volume
from strata.operators.counting import counted
from strata.spec import ROLES, Roles


@dataclass(frozen=True)
class Options:
    reference_year: int
    first_year: int = evolution.FIRST_YEAR
    last_year: int = evolution.LAST_YEAR


Build = Callable[[DataFrame, Roles, Options], DataFrame]


@dataclass(frozen=True)
class Analysis:
    """One named output.

    ``counts_over`` names roles whose combinations, counted once, serve as input
    instead of the records. An analysis with ``parents`` is derived from those
    outputs and reads no records at all.
    """

    name: str
    family: str
    requires: tuple[str, ...]
    build: Build | None = None
    counts_over: tuple[str, ...] = ()
    parents: tuple[str, ...] = ()
    derive: Callable[..., DataFrame] | None = None

    def available(self, df: DataFrame, roles: Roles) -> bool:
        return all(getattr(roles, role) in df.columns for role in self.requires)

    def make(
        self, df: DataFrame, roles: Roles, options: Options, made: Mapping[str, DataFrame]
    ) -> DataFrame:
        if self.parents:
            return self.derive(*[made[parent] for parent in self.parents])
        return self.build(df, roles, options)


def _evolution(df: DataFrame, roles: Roles, o: Options) -> DataFrame:
    return evolution.neighborhood_evolution(df, roles, o.first_year, o.last_year)


_VOLUME = "volume_analysis"
_DISTRIBUTION = "distribution_analysis"
_TAX = "tax_value_analysis"
_AGE = "age_analysis"
_AGE_VALUE = "age_value_analysis"
_EVOLUTION = "evolution_analysis"
_GOLD = "gold"
_REPORT = "report"

_KINDS = ("year", "use_type", "neighborhood", "construction_type")
_BUILT = ("built_year",)
_EVOLUTION_NEEDS = ("neighborhood", "year", "tax_value")


def _count(name: str, family: str, requires: tuple[str, ...], build: Callable) -> Analysis:
    """An analysis that only counts, and so can run on counted combinations."""
    return Analysis(name, family, requires, lambda df, roles, _: build(df, roles), _KINDS)


ANALYSES: tuple[Analysis, ...] = (
    _count("total_properties", _VOLUME, (), volume.total_properties),
    _count("volume_by_year", _VOLUME, ("year",), volume.volume_by_year),
    _count("volume_by_type", _VOLUME, ("use_type",), volume.volume_by_type),
    _count("volume_by_neighborhood", _VOLUME, ("neighborhood",), volume.volume_by_neighborhood),
    _count("volume_by_year_type", _VOLUME, ("year", "use_type"), volume.volume_by_year_type),
    _count(
        "volume_by_year_neighborhood", _VOLUME, ("year", "neighborhood"),
        volume.volume_by_year_neighborhood,
    ),
    _count("distribution_by_type", _DISTRIBUTION, ("use_type",), volume.distribution_by_type),
    _count(
        "distribution_by_neighborhood_top20", _DISTRIBUTION, ("neighborhood",),
        volume.distribution_by_neighborhood_top,
    ),
    _count("distribution_by_year", _DISTRIBUTION, ("year",), volume.distribution_by_year),
    _count(
        "distribution_by_construction", _DISTRIBUTION, ("construction_type",),
        volume.distribution_by_construction,
    ),
    _count(
        "top_neighborhoods_by_year", _DISTRIBUTION, ("neighborhood", "year"),
        volume.top_neighborhoods_by_year,
    ),
    Analysis(
        "tax_stats_by_year", _TAX, ("year", "tax_value"),
        lambda d, r, o: value.tax_stats_by_year(d, r),
    ),
    Analysis(
        "avg_tax_by_neighborhood_top20", _TAX, ("neighborhood", "tax_value"),
        lambda d, r, o: value.avg_tax_by_neighborhood_top(d, r),
    ),
    Analysis(
        "property_value_by_year", _TAX, ("year", "property_value"),
        lambda d, r, o: value.property_value_by_year(d, r),
    ),
    Analysis(
        "age_distribution_by_range", _AGE, ("built_year",),
        lambda d, r, o: age.age_distribution(d, o.reference_year, r), _BUILT,
    ),
    Analysis(
        "age_statistics", _AGE, ("built_year",),
        lambda d, r, o: age.age_statistics(d, o.reference_year, r), _BUILT,
    ),
    Analysis(
        "age_value_relationship", _AGE_VALUE, ("built_year", "tax_value", "property_value"),
        lambda d, r, o: age.age_value_relationship(d, o.reference_year, r),
    ),
    Analysis("neighborhood_evolution", _EVOLUTION, _EVOLUTION_NEEDS, _evolution),
    Analysis(
        "top_growth_quantity", _EVOLUTION, _EVOLUTION_NEEDS,
        parents=("neighborhood_evolution",), derive=evolution.top_growth_quantity,
    ),
    Analysis(
        "top_growth_value", _EVOLUTION, _EVOLUTION_NEEDS,
        parents=("neighborhood_evolution",), derive=evolution.top_growth_value,
    ),
)

REPORTS: tuple[Analysis, ...] = (
    Analysis(
        "summary_report", _REPORT, ("year", "use_type", "neighborhood", "tax_value"),
        parents=(
            "total_properties", "volume_by_year", "volume_by_type", "volume_by_neighborhood",
            "tax_stats_by_year",
        ),
        derive=reshape.summary_report_rows,
    ),
)

GOLD_OUTPUTS: tuple[Analysis, ...] = (
    Analysis(
        "summary_by_year_type", _GOLD, ("year", "use_type", "tax_value"),
        lambda d, r, o: gold.summary_by_year_type(d, r),
    ),
    Analysis(
        "summary_by_neighborhood", _GOLD,
        ("neighborhood", "year", "tax_value", "land_area", "built_area"),
        lambda d, r, o: gold.summary_by_neighborhood(d, r),
    ),
    Analysis(
        "year_over_year_trends", _GOLD, ("year", "tax_value", "land_area", "built_area"),
        lambda d, r, o: gold.year_over_year_trends(d, r),
    ),
)


def available(
    df: DataFrame, roles: Roles = ROLES, analyses: Iterable[Analysis] = ANALYSES
) -> list[Analysis]:
    return [a for a in analyses if a.available(df, roles)]


def counts_for(df: DataFrame, roles: Roles, over: tuple[str, ...]) -> DataFrame:
    """Combinations of those of the roles' columns that ``df`` has, counted."""
    columns = [getattr(roles, role) for role in over]
    return counted(df, [c for c in columns if c in df.columns])


def build_all(
    df: DataFrame, options: Options, roles: Roles = ROLES, analyses: Iterable[Analysis] = ANALYSES
) -> dict[str, DataFrame]:
    """Every analysis the table's columns allow, by name."""
    made: dict[str, DataFrame] = {}
    for analysis in available(df, roles, analyses):
        made[analysis.name] = analysis.make(df, roles, options, made)
    return made
