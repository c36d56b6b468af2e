"""Business-ready summaries of the consolidated table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from strata.operators import partials
from strata.spec import ROLES, Roles


@dataclass(frozen=True)
class Summary:
    """Keys and outputs (kind of aggregate, measure) of a summary, by roles."""

    keys: tuple[str, ...]
    outputs: dict[str, tuple[str, str | None]]

    def columns(self, roles: Roles) -> list[str]:
        return [getattr(roles, key) for key in self.keys]

    def of(self, roles: Roles) -> partials.Outputs:
        return {name: (kind, role and getattr(roles, role)) for name, (kind, role) in self.outputs.items()}

    def measures(self, roles: Roles) -> list[str]:
        return list(dict.fromkeys(getattr(roles, role) for _, role in self.outputs.values() if role))


SUMMARIES = {
    "summary_by_year_type": Summary(
        ("year", "use_type"),
        {
            "total_imoveis": ("rows", None),
            "total_iptu_value": ("sum", "tax_value"),
            "avg_iptu_value": ("avg", "tax_value"),
            "min_iptu_value": ("min", "tax_value"),
            "max_iptu_value": ("max", "tax_value"),
        },
    ),
    "summary_by_neighborhood": Summary(
        ("neighborhood", "year"),
        {
            "total_imoveis": ("rows", None),
            "total_iptu_value": ("sum", "tax_value"),
            "avg_terrain_area": ("avg", "land_area"),
            "avg_built_area": ("avg", "built_area"),
        },
    ),
    "year_over_year_trends": Summary(
        ("year",),
        {
            "total_imoveis": ("rows", None),
            "total_iptu_value": ("sum", "tax_value"),
            "avg_iptu_value": ("avg", "tax_value"),
            "total_terrain_area": ("sum", "land_area"),
            "total_built_area": ("sum", "built_area"),
        },
    ),
}


def _summary(df: DataFrame, name: str, roles: Roles) -> DataFrame:
    chosen = SUMMARIES[name]
    return partials.summary(df, chosen.columns(roles), chosen.of(roles))


def summary_by_year_type(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return _summary(df, "summary_by_year_type", roles)


def summary_by_neighborhood(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return _summary(df, "summary_by_neighborhood", roles)


def year_over_year_trends(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return _summary(df, "year_over_year_trends", roles)


def states(df: DataFrame, name: str, roles: Roles = ROLES, along: Sequence[str] = ()) -> DataFrame:
    """A summary's partial states, apart for each combination of the ``along`` columns."""
    chosen = SUMMARIES[name]
    return partials.states(df, [*dict.fromkeys([*chosen.columns(roles), *along])], chosen.measures(roles))


def from_states(df: DataFrame, name: str, roles: Roles = ROLES) -> DataFrame:
    """The summary, merged from partial states."""
    chosen = SUMMARIES[name]
    return partials.merged(df, chosen.columns(roles), chosen.of(roles))


def full_consolidated(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return df


def stamped(df: DataFrame, output_type: str) -> DataFrame:
    """Add when the output was made and which output it is."""
    return df.withColumns(
        {"_gold_timestamp": F.current_timestamp(), "_output_type": F.lit(output_type)}
    )
