"""The star-schema test tables seen as canonical records.

Only the tables that the asked-for columns come from are joined, by left joins
on unique keys, so every order or line stays exactly one record. The joins
carry no hints: Catalyst broadcasts a side whose file size is under its
threshold and sort-merges a larger one, where adaptive execution splits skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions import sqltext
from strata.operators import partials
from strata.operators.counting import ROWS, counted
from strata.spec import ROLES

R = ROLES

_FROM_ORDERS: dict[str, tuple[str, str]] = {
    R.entity: ("cast(o_custkey as string)", "orders"),
    R.year: ("year(o_orderdate)", "orders"),
    R.registered: ("to_date(o_orderdate)", "orders"),
    R.use_type: ("o_orderpriority", "orders"),
    R.tax_value: ("o_totalprice", "orders"),
    R.construction_type: ("c_mktsegment", "customer"),
    R.property_value: ("c_acctbal", "customer"),
    R.neighborhood: ("n_name", "nation"),
}

_FROM_LINES: dict[str, tuple[str, str]] = {
    R.entity: ("cast(l_orderkey as string)", "lineitem"),
    R.year: ("year(l_shipdate)", "lineitem"),
    R.use_type: ("l_returnflag", "lineitem"),
    R.construction_type: ("l_linestatus", "lineitem"),
    R.tax_value: ("l_tax", "lineitem"),
    R.property_value: ("l_extendedprice", "lineitem"),
    R.land_area: ("l_quantity", "lineitem"),
    R.built_area: ("l_extendedprice", "lineitem"),
    R.built_year: ("year(l_shipdate) - cast(l_quantity as int)", "lineitem"),
    R.neighborhood: ("n_name", "nation"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_records(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """One record per order: customer's nation as neighbourhood, price as tax."""
    wanted = columns or tuple(_FROM_ORDERS)
    rows = _with_customers(spark, folder, table(spark, folder, "orders"), wanted)
    return rows.select(*[F.expr(_FROM_ORDERS[c][0]).alias(c) for c in wanted])


def order_counts(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``order_records`` of columns that are only counted, counted already.

    Orders are counted per customer before the join, so a customer with a third
    of all orders reaches it as one row per combination instead of row by row.
    """
    own = [c for c in columns if _FROM_ORDERS[c][1] == "orders"]
    keyed = table(spark, folder, "orders").select(
        "o_custkey", *[F.expr(_FROM_ORDERS[c][0]).alias(c) for c in own]
    )
    rows = _with_customers(spark, folder, counted(keyed, ["o_custkey", *own]), columns)
    others = {c: _FROM_ORDERS[c][0] for c in columns if c not in own}
    return rows.select(
        *[F.col(sqltext.name(c)) if c in own else F.col(others[c]).alias(c) for c in columns], ROWS
    )


def order_states(
    spark: SparkSession, folder: str, keys: list[str], measures: list[str], only: str | None = None
) -> DataFrame:
    """``order_records`` as partial states of the measures by ``keys``.

    Orders are aggregated per customer before the join; ``only`` is a condition on them.
    """
    own = [c for c in keys if _FROM_ORDERS[c][1] == "orders"]
    rows = table(spark, folder, "orders").select("o_custkey", *[F.expr(_FROM_ORDERS[c][0]).alias(c) for c in [*own, *measures]])
    held = partials.states(rows if only is None else rows.where(only), ["o_custkey", *own], measures)
    kept = [c for c in held.columns if c not in ("o_custkey", *own)]
    joined = _with_customers(spark, folder, held, tuple(keys))
    return joined.select(*[F.col(sqltext.name(c)) if c in own else F.col(_FROM_ORDERS[c][0]).alias(c) for c in keys], *[sqltext.name(c) for c in kept])


def line_states(spark: SparkSession, folder: str, keys: list[str], measures: list[str]) -> DataFrame:
    """``line_records`` as partial states of the measures by ``keys``; lines are aggregated per supplier before the join."""
    own = [c for c in keys if _FROM_LINES[c][1] == "lineitem"]
    rows = table(spark, folder, "lineitem").select("l_suppkey", *[F.expr(_FROM_LINES[c][0]).alias(c) for c in [*own, *measures]])
    held = partials.states(rows, ["l_suppkey", *own], measures)
    kept = [c for c in held.columns if c not in ("l_suppkey", *own)]
    joined = _with_suppliers(spark, folder, held)
    return joined.select(*[F.col(sqltext.name(c)) if c in own else F.col(_FROM_LINES[c][0]).alias(c) for c in keys], *[sqltext.name(c) for c in kept])


def _with_customers(
    spark: SparkSession, folder: str, rows: DataFrame, wanted: tuple[str, ...]
) -> DataFrame:
    """Join the customer and nation of each order, as far as the columns need them."""
    needed = {_FROM_ORDERS[c][1] for c in wanted}
    if needed & {"customer", "nation"}:
        customers = table(spark, folder, "customer")
        rows = rows.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "nation" in needed:
        nations = table(spark, folder, "nation")
        rows = rows.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows


def line_records(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """One record per order line: supplier's nation, tax rate with many zeros, areas."""
    wanted = columns or tuple(_FROM_LINES)
    needed = {_FROM_LINES[c][1] for c in wanted}
    rows = table(spark, folder, "lineitem")
    if "nation" in needed:
        rows = _with_suppliers(spark, folder, rows)
    return rows.select(*[F.expr(_FROM_LINES[c][0]).alias(c) for c in wanted])


def _with_suppliers(spark: SparkSession, folder: str, rows: DataFrame) -> DataFrame:
    suppliers = table(spark, folder, "supplier")
    nations = table(spark, folder, "nation")
    rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return rows.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels, NULL where a document has none."""
    documents = table(spark, folder, "documents")
    return documents.join(table(spark, folder, "labels"), "doc_id", "left")


def tidy(df: DataFrame, digits: int = 4) -> DataFrame:
    """Comparable results: whole numbers as bigint, doubles rounded."""
    columns = []
    for field in df.schema.fields:
        name, kind = sqltext.name(field.name), field.dataType.typeName()
        value = name
        if kind in ("integer", "short", "byte"):
            value = f"CAST({name} AS BIGINT)"
        elif kind in ("double", "float"):
            value = f"round({name}, {digits})"
        elif kind == "date":
            value = f"date_format({name}, 'yyyy-MM-dd')"
        columns.append(f"{value} AS {name}")
    return df.selectExpr(*columns)
