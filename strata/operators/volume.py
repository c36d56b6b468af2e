"""How many records there are, and how they spread over years, types and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.operators.counting import (
    count_by,
    row_count,
    top_k,
    top_k_per_group,
    with_share,
    without_null_keys,
)
from strata.spec import ROLES, Roles


def total_properties(df: DataFrame, roles: Roles = ROLES) -> DataFrame:
    return df.agg(row_count(df).alias("value")).select(
        F.lit("Total de Imóveis").alias("metric"), "value"
    )


def volume_by_year(df: DataFrame, roles: Roles = ROLES, drop_null_keys: bool = False) -> DataFrame:
    return count_by(df, {"ano": roles.year}, "total_imoveis", drop_null_keys).orderBy("ano")


def volume_by_type(df: DataFrame, roles: Roles = ROLES, drop_null_keys: bool = False) -> DataFrame:
    return _counts_with_share(df, {"tipo_uso": roles.use_type}, "total_imoveis", drop_null_keys)


def volume_by_neighborhood(
    df: DataFrame, roles: Roles = ROLES, drop_null_keys: bool = False
) -> DataFrame:
    return _counts_with_share(df, {"bairro": roles.neighborhood}, "total_imoveis", drop_null_keys)


def volume_by_year_type(
    df: DataFrame, roles: Roles = ROLES, drop_null_keys: bool = False
) -> DataFrame:
    keys = {"ano": roles.year, "tipo_uso": roles.use_type}
    return count_by(df, keys, "total_imoveis", drop_null_keys).orderBy("ano", "tipo_uso")


def volume_by_year_neighborhood(
    df: DataFrame, roles: Roles = ROLES, drop_null_keys: bool = False
) -> DataFrame:
    keys = {"ano": roles.year, "bairro": roles.neighborhood}
    counts = count_by(df, keys, "total_imoveis", drop_null_keys)
    return counts.orderBy("ano", F.desc("total_imoveis"), "bairro")


def distribution_by_type(
    df: DataFrame, roles: Roles = ROLES, drop_null_keys: bool = False
) -> DataFrame:
    return _counts_with_share(df, {"tipo_uso": roles.use_type}, "quantidade", drop_null_keys)


def distribution_by_neighborhood_top(
    df: DataFrame, roles: Roles = ROLES, k: int = 20, drop_null_keys: bool = False
) -> DataFrame:
    """Greatest neighbourhoods; the share is of all rows, not of the k shown."""
    counts = _with_share(df, {"bairro": roles.neighborhood}, "quantidade", drop_null_keys)
    return top_k(counts, "quantidade", k, ["bairro"])


def distribution_by_year(
    df: DataFrame, roles: Roles = ROLES, drop_null_keys: bool = False
) -> DataFrame:
    return _with_share(df, {"ano": roles.year}, "quantidade", drop_null_keys).orderBy("ano")


def distribution_by_construction(
    df: DataFrame, roles: Roles = ROLES, drop_null_keys: bool = False
) -> DataFrame:
    keys = {"tipo_construcao": roles.construction_type}
    return _counts_with_share(df, keys, "quantidade", drop_null_keys)


def top_neighborhoods_by_year(
    df: DataFrame, roles: Roles = ROLES, k: int = 10, drop_null_keys: bool = False
) -> DataFrame:
    keys = {"bairro": roles.neighborhood, "ano": roles.year}
    counts = count_by(df, keys, "quantidade", drop_null_keys)
    top = top_k_per_group(counts, ["ano"], "quantidade", k, ["bairro"])
    return top.select("bairro", "quantidade", "ano")


def _with_share(df: DataFrame, keys: dict[str, str], name: str, drop_null_keys: bool) -> DataFrame:
    """Counts and shares of all rows, also where groups without a key are not shown."""
    counts = with_share(count_by(df, keys, name), name)
    return without_null_keys(counts, keys) if drop_null_keys else counts


def _counts_with_share(
    df: DataFrame, keys: dict[str, str], name: str, drop_null_keys: bool = False
) -> DataFrame:
    """Counts and shares of all rows, greatest first."""
    return _with_share(df, keys, name, drop_null_keys).orderBy(F.desc(name), *keys)
