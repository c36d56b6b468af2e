"""Every operator run on the test tables, next to the SQL it must agree with.

Results are made comparable by ``tidy``: whole numbers as BIGINT, doubles
rounded, dates as text. Each query covers its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from strata.functions import scalars, sqltext
from strata.functions.scalars import quoted
from strata.operators import age, align, evolution, export, gold, profile, quality, reshape, value, volume
from strata.operators.small_side import keep_new_keys
from strata.plans.tables import (
    R,
    labelled_documents,
    line_records,
    line_states,
    order_counts,
    order_records,
    order_states,
    table,
    tidy,
)
from strata.spec import Domain, Roles, Spec

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

REFERENCE_YEAR = 2008
EARLY_REFERENCE_YEAR = 1985
FIRST_YEAR, LAST_YEAR = 1995, 2000


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLE_SQL[name] = sql
        return build

    return register


# The records of strata.plans.tables, as SQL.
_ORDERS = """
WITH records AS (
  SELECT CAST(o_custkey AS VARCHAR) AS entity, CAST(year(o_orderdate) AS BIGINT) AS ano,
         CAST(o_orderdate AS DATE) AS registered, o_orderpriority AS tipo_uso,
         o_totalprice AS tax, c_mktsegment AS tipo_construcao, c_acctbal AS property_value,
         n_name AS bairro
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
              LEFT JOIN nation ON c_nationkey = n_nationkey)
"""
_LINES = """
WITH records AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS entity, CAST(year(l_shipdate) AS BIGINT) AS ano,
         l_returnflag AS tipo_uso, l_linestatus AS tipo_construcao, l_tax AS tax,
         l_extendedprice AS property_value, l_quantity AS land, l_extendedprice AS built,
         CAST(year(l_shipdate) - CAST(l_quantity AS INTEGER) AS BIGINT) AS built_year,
         n_name AS bairro
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
                LEFT JOIN nation ON s_nationkey = n_nationkey)
"""

# ---- volume and distribution ----------------------------------------------


@query("volume_total", "SELECT 'Total de Imóveis' AS metric, count(*) AS value FROM orders")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(volume.total_properties(order_records(spark, folder, R.entity)))


@query("volume_by_year", _ORDERS + "SELECT ano, count(*) AS total_imoveis FROM records GROUP BY ano")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(volume.volume_by_year(order_records(spark, folder, R.year)))


def _share_sql(records: str, key: str, name: str) -> str:
    return records + f"""
SELECT {key}, n AS {name}, round(n / (SELECT count(*) FROM records) * 100, 2) AS percentual
FROM (SELECT {key}, count(*) AS n FROM records GROUP BY {key})"""


@query("volume_by_type", _share_sql(_ORDERS, "tipo_uso", "total_imoveis"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(volume.volume_by_type(order_records(spark, folder, R.use_type)))


@query("volume_by_neighborhood", _share_sql(_ORDERS, "bairro", "total_imoveis"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(volume.volume_by_neighborhood(order_counts(spark, folder, R.neighborhood)))


@query(
    "volume_by_year_type",
    _ORDERS + "SELECT ano, tipo_uso, count(*) AS total_imoveis FROM records GROUP BY ano, tipo_uso",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(volume.volume_by_year_type(order_records(spark, folder, R.year, R.use_type)))


@query(
    "volume_by_year_neighborhood",
    _ORDERS + "SELECT ano, bairro, count(*) AS total_imoveis FROM records GROUP BY ano, bairro",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_counts(spark, folder, R.year, R.neighborhood)
    return tidy(volume.volume_by_year_neighborhood(rows))


@query("distribution_by_type", _share_sql(_ORDERS, "tipo_uso", "quantidade"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(volume.distribution_by_type(order_records(spark, folder, R.use_type)))


@query(
    "distribution_top20",
    _share_sql(_ORDERS, "bairro", "quantidade") + " ORDER BY quantidade DESC, bairro LIMIT 20",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_counts(spark, folder, R.neighborhood)
    return tidy(volume.distribution_by_neighborhood_top(rows))


@query("distribution_by_year", _share_sql(_ORDERS, "ano", "quantidade"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(volume.distribution_by_year(order_records(spark, folder, R.year)))


@query("distribution_by_construction", _share_sql(_ORDERS, "tipo_construcao", "quantidade"))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(volume.distribution_by_construction(order_counts(spark, folder, R.construction_type)))


_TOP_PER_YEAR = """
, counts AS (SELECT ano, bairro, count(*) AS quantidade FROM records GROUP BY ano, bairro)
, top AS (SELECT bairro, quantidade, ano FROM counts
  QUALIFY row_number() OVER (PARTITION BY ano ORDER BY quantidade DESC, bairro) <= 10)
"""


@query("top_k_per_year", _ORDERS + _TOP_PER_YEAR + "SELECT * FROM top")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_counts(spark, folder, R.year, R.neighborhood)
    return tidy(volume.top_neighborhoods_by_year(rows))


# ---- value -----------------------------------------------------------------

_TAX_STATS = """
SELECT ano, round(avg(tax) FILTER (tax > 0), 4) AS media,
       round(median(tax) FILTER (tax > 0), 4) AS mediana,
       round(min(tax) FILTER (tax > 0), 4) AS minimo,
       round(max(tax) FILTER (tax > 0), 4) AS maximo,
       round(sum(tax), 4) AS total, count(*) AS count, count(*) FILTER (tax > 0) AS count_nonzero
FROM records WHERE tax IS NOT NULL GROUP BY ano"""


@query("tax_stats_by_year", _LINES + _TAX_STATS)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(value.tax_stats_by_year(line_records(spark, folder, R.year, R.tax_value)))


@query("tax_stats_outer_join", _LINES + _TAX_STATS)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(value.tax_stats_by_year_joined(line_records(spark, folder, R.year, R.tax_value)))


@query(
    "tax_stats_all_zero",
    """
SELECT ano, round(avg(tax), 4) AS media, round(median(tax), 4) AS mediana,
       round(min(tax), 4) AS minimo, round(max(tax), 4) AS maximo, round(sum(tax), 4) AS total,
       count(*) AS count, count(*) FILTER (tax > 0) AS count_nonzero
FROM (SELECT CAST(year(l_shipdate) AS BIGINT) AS ano, l_tax * 0 - l_discount AS tax FROM lineitem)
GROUP BY ano""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """No tax above zero anywhere: the statistics are of all readable taxes."""
    rows = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias(R.year),
        (F.col("l_tax") * 0 - F.col("l_discount")).alias(R.tax_value),
    )
    return tidy(value.tax_stats_by_year(rows))


@query(
    "avg_tax_top20",
    _LINES
    + """
SELECT bairro, round(avg(tax), 8) AS media, round(sum(tax), 8) AS total, count(*) AS count
FROM records WHERE tax IS NOT NULL GROUP BY bairro ORDER BY avg(tax) DESC, bairro LIMIT 20""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_states(spark, folder, [R.neighborhood], [R.tax_value])
    return tidy(value.avg_tax_by_neighborhood_top(rows), 8)


@query(
    "property_value_by_year",
    _ORDERS
    + """
SELECT ano, round(avg(property_value), 4) AS media, round(median(property_value), 4) AS mediana,
       round(sum(property_value), 4) AS total, count(*) AS count
FROM records GROUP BY ano""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(value.property_value_by_year(order_records(spark, folder, R.year, R.property_value)))


# ---- age -------------------------------------------------------------------


def _band_sql(bands: int, age_sql: str, closed: bool = True) -> str:
    tops = [10, 20, 30, 40, 50, 60][: bands - 1]
    suffix = " anos" if bands == 7 else ""
    sign = "<=" if closed else "<"
    low = [0] + [t + 1 for t in tops[:-1]]
    cases = " ".join(
        f"WHEN {age_sql} {sign} {top} THEN '{start}-{top}{suffix}'" for start, top in zip(low, tops)
    )
    return f"CASE {cases} ELSE '{tops[-1]}+{suffix}' END"


def _ordinal_sql(bands: int, column: str) -> str:
    return f"CASE WHEN {column} LIKE '%+%' THEN {bands} ELSE CAST(CAST(left({column}, 1) AS INTEGER) + 1 AS BIGINT) END"


def _age_distribution_sql(closed: bool) -> str:
    return (
        _LINES
        + f"""
, banded AS (SELECT {_band_sql(7, f'({REFERENCE_YEAR} - built_year)', closed)} AS faixa_idade
  FROM records WHERE built_year > 0 AND built_year <= {REFERENCE_YEAR})
SELECT faixa_idade, count(*) AS quantidade,
       round(count(*) / (SELECT count(*) FROM banded) * 100, 2) AS percentual,
       CAST({_ordinal_sql(7, 'faixa_idade')} AS BIGINT) AS ordem
FROM banded GROUP BY faixa_idade"""
    )


@query("age_distribution", _age_distribution_sql(True))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(age.age_distribution(line_records(spark, folder, R.built_year), REFERENCE_YEAR))


@query("age_distribution_left_closed", _age_distribution_sql(False))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_records(spark, folder, R.built_year)
    return tidy(age.age_distribution(rows, REFERENCE_YEAR, right_closed=False))


@query(
    "age_band_ordered",
    "SELECT ordem, faixa_idade, quantidade FROM (" + _age_distribution_sql(True) + ")",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    bands = age.age_distribution(line_records(spark, folder, R.built_year), REFERENCE_YEAR)
    return tidy(bands.select("ordem", "faixa_idade", "quantidade").orderBy("ordem"))


_AGES = (
    _LINES
    + f""", ages AS (SELECT {REFERENCE_YEAR} - built_year AS age FROM records
  WHERE built_year > 0 AND built_year <= {REFERENCE_YEAR})
"""
)


@query(
    "age_statistics",
    _AGES
    + """SELECT round(avg(age), 4) AS media, round(median(age), 4) AS mediana,
    CAST(min(age) AS BIGINT) AS minimo, CAST(max(age) AS BIGINT) AS maximo FROM ages""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(age.age_statistics(line_records(spark, folder, R.built_year), REFERENCE_YEAR))


@query(
    "age_statistics_long",
    _AGES
    + """SELECT 'media' AS metrica, round(avg(age), 4) AS valor FROM ages
UNION ALL SELECT 'mediana', round(median(age), 4) FROM ages
UNION ALL SELECT 'minimo', CAST(min(age) AS DOUBLE) FROM ages
UNION ALL SELECT 'maximo', CAST(max(age) AS DOUBLE) FROM ages""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(age.age_statistics_long(line_records(spark, folder, R.built_year), REFERENCE_YEAR))


def _age_value_sql(year: int) -> str:
    return (
        _LINES
        + f"""
, banded AS (SELECT {_band_sql(6, f'({year} - built_year)')} AS faixa_idade, tax
  FROM records WHERE built_year > 0 AND built_year <= {year} AND tax > 0)
SELECT faixa_idade, round(avg(tax), 8) AS valor_medio, count(*) AS quantidade,
       CAST({_ordinal_sql(6, 'faixa_idade')} AS BIGINT) AS ordem
FROM banded GROUP BY faixa_idade"""
    )


@query("age_value", _age_value_sql(REFERENCE_YEAR))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_records(spark, folder, R.built_year, R.tax_value)
    return tidy(age.age_value_relationship(rows, REFERENCE_YEAR), 8)


@query("age_value_early_reference", _age_value_sql(EARLY_REFERENCE_YEAR))
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Many lines are built after this reference year and must not count."""
    rows = line_records(spark, folder, R.built_year, R.tax_value)
    return tidy(age.age_value_relationship(rows, EARLY_REFERENCE_YEAR), 8)


@query(
    "valid_build_year",
    _LINES
    + f"""
SELECT built_year AS ano_construcao, {EARLY_REFERENCE_YEAR} - built_year AS idade_construcao,
       count(*) AS n
FROM records WHERE built_year > 0 AND built_year <= {EARLY_REFERENCE_YEAR} GROUP BY 1, 2""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    aged = age.with_age(line_records(spark, folder, R.built_year), EARLY_REFERENCE_YEAR)
    return tidy(aged.groupBy("ano_construcao", "idade_construcao").agg(F.count(F.lit(1)).alias("n")))


def _age_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    built = F.expr("year(l_shipdate) - cast(l_quantity as int)")
    return rows.select(
        "l_orderkey", "l_linenumber", scalars.age_in_years(built, REFERENCE_YEAR).alias("idade")
    )


_AGE_ROWS = f"""
WITH ages AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST({REFERENCE_YEAR} - (year(l_shipdate) - CAST(l_quantity AS INTEGER)) AS BIGINT) AS idade
  FROM lineitem)
"""


@query("age_column", _AGE_ROWS + "SELECT * FROM ages")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(_age_rows(spark, folder))


@query("age_band7", _AGE_ROWS + f"SELECT *, {_band_sql(7, 'idade')} AS faixa_idade FROM ages")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _age_rows(spark, folder)
    return tidy(rows.withColumn("faixa_idade", scalars.age_band(F.col("idade"))))


@query("age_band6", _AGE_ROWS + f"SELECT *, {_band_sql(6, 'idade')} AS faixa_idade FROM ages")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _age_rows(spark, folder)
    band = scalars.age_band(F.col("idade"), age.AGE_BANDS_6)
    return tidy(rows.withColumn("faixa_idade", band))


# ---- evolution -------------------------------------------------------------

_EVOLUTION = (
    _ORDERS
    + f"""
, stats AS (SELECT bairro, ano, count(*) AS n, avg(tax) AS v FROM records
  WHERE tax > 0 AND ano BETWEEN {FIRST_YEAR} AND {LAST_YEAR} GROUP BY bairro, ano)
, ends AS (SELECT min(ano) AS a, max(ano) AS b FROM stats)
, grown AS (
  SELECT i.bairro, i.n AS quantidade_inicial, i.v AS valor_medio_inicial,
         f.n AS quantidade_final, f.v AS valor_medio_final,
         (f.n - i.n) / i.n * 100 AS crescimento_quantidade,
         (f.v - i.v) / i.v * 100 AS crescimento_valor
  FROM stats i JOIN stats f ON i.bairro = f.bairro, ends
  WHERE i.ano = ends.a AND f.ano = ends.b AND ends.a < ends.b AND i.n > 10)
"""
)
_GROWN = """
SELECT bairro, quantidade_inicial, round(valor_medio_inicial, 4) AS valor_medio_inicial,
       quantidade_final, round(valor_medio_final, 4) AS valor_medio_final,
       round(crescimento_quantidade, 4) AS crescimento_quantidade,
       round(crescimento_valor, 4) AS crescimento_valor
FROM grown """


def _taxed(spark: SparkSession, folder: str) -> DataFrame:
    return order_states(spark, folder, [R.neighborhood, R.year], [R.tax_value], only=f"`{R.tax_value}` > 0")


def _evolution(spark: SparkSession, folder: str) -> DataFrame:
    rows = _taxed(spark, folder)
    return evolution.neighborhood_evolution(rows, first_year=FIRST_YEAR, last_year=LAST_YEAR)


@query("evolution", _EVOLUTION + _GROWN)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(_evolution(spark, folder))


@query("evolution_join", _EVOLUTION + _GROWN)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _taxed(spark, folder)
    joined = evolution.neighborhood_evolution_joined(
        rows, first_year=FIRST_YEAR, last_year=LAST_YEAR
    )
    return tidy(joined)


@query(
    "top_growth_quantity",
    _EVOLUTION + _GROWN + "ORDER BY grown.crescimento_quantidade DESC, bairro LIMIT 20",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evolution.top_growth_quantity(_evolution(spark, folder)))


@query(
    "top_growth_value",
    _EVOLUTION + _GROWN + "ORDER BY grown.crescimento_valor DESC, bairro LIMIT 20",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evolution.top_growth_value(_evolution(spark, folder)))


@query(
    "growth_positive_or_worst",
    _EVOLUTION
    + ", flag AS (SELECT coalesce(max(crescimento_quantidade) > 0, false) AS pos FROM grown)"
    + _GROWN
    + """, flag WHERE (pos AND grown.crescimento_quantidade > 0) OR NOT pos
ORDER BY CASE WHEN pos THEN -grown.crescimento_quantidade ELSE grown.crescimento_quantidade END, bairro
LIMIT 15""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(evolution.growth_positive_or_worst(_evolution(spark, folder)))


# ---- gold ------------------------------------------------------------------

_ANO, _TIPO, _BAIRRO = '"ano do exercício"', '"tipo de uso do imóvel"', '"bairro"'


@query(
    "gold_year_type",
    _ORDERS
    + f"""
SELECT ano AS {_ANO}, tipo_uso AS {_TIPO}, count(*) AS total_imoveis,
       round(sum(tax), 2) AS total_iptu_value, round(avg(tax), 2) AS avg_iptu_value,
       round(min(tax), 2) AS min_iptu_value, round(max(tax), 2) AS max_iptu_value,
       'summary_by_year_type' AS _output_type
FROM records GROUP BY ano, tipo_uso""",
)
def gold_year_type(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_records(spark, folder, R.year, R.use_type, R.tax_value)
    out = gold.stamped(gold.summary_by_year_type(rows), "summary_by_year_type")
    return tidy(out.drop("_gold_timestamp"), 2)


@query(
    "gold_neighborhood",
    _LINES
    + f"""
SELECT bairro AS {_BAIRRO}, ano AS {_ANO}, count(*) AS total_imoveis,
       round(sum(tax), 4) AS total_iptu_value, round(avg(land), 4) AS avg_terrain_area,
       round(avg(built), 4) AS avg_built_area, 'summary_by_neighborhood' AS _output_type
FROM records GROUP BY bairro, ano""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_states(
        spark, folder, [R.neighborhood, R.year], [R.tax_value, R.land_area, R.built_area]
    )
    out = gold.stamped(gold.summary_by_neighborhood(rows), "summary_by_neighborhood")
    return tidy(out.drop("_gold_timestamp"))


@query(
    "gold_trends",
    _LINES
    + f"""
SELECT ano AS {_ANO}, count(*) AS total_imoveis, round(sum(tax), 2) AS total_iptu_value,
       round(avg(tax), 2) AS avg_iptu_value, round(sum(land), 2) AS total_terrain_area,
       round(sum(built), 2) AS total_built_area, 'year_over_year_trends' AS _output_type
FROM records GROUP BY ano""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_records(spark, folder, R.year, R.tax_value, R.land_area, R.built_area)
    out = gold.stamped(gold.year_over_year_trends(rows), "year_over_year_trends")
    return tidy(out.drop("_gold_timestamp"), 2)


@query(
    "gold_full",
    _ORDERS
    + f"""
SELECT entity AS "Número do contribuinte", ano AS {_ANO}, tipo_uso AS {_TIPO},
       round(tax, 4) AS "valor IPTU", 'full_consolidated' AS _output_type FROM records""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_records(spark, folder, R.entity, R.year, R.use_type, R.tax_value)
    out = gold.stamped(gold.full_consolidated(rows), "full_consolidated")
    return tidy(out.drop("_gold_timestamp"))


# ---- projections and alignment ---------------------------------------------


@query(
    "parse_currency",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE round(o_totalprice, 2) END AS valor,
       round(o_totalprice, 2) AS numeric_input
FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Text such as ``R$ 1234,56``, with unreadable text for one order status."""
    text = F.replace(F.format_string("R$ %.2f ", F.col("o_totalprice")), F.lit("."), F.lit(","))
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "P", "n/d").otherwise(text).alias("text"),
    )
    parsed = scalars.parse_currency("text")
    number = scalars.parse_currency("o_totalprice")
    return tidy(rows.select("o_orderkey", parsed.alias("valor"), number.alias("numeric_input")), 2)


@query(
    "cast_lenient",
    """
SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS DOUBLE) AS digit, CAST(NULL AS DOUBLE) AS words,
       CAST(year(o_orderdate) AS BIGINT) AS year_number
FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        F.left("o_orderpriority", F.lit(1)).alias("first"),
        F.concat(F.year("o_orderdate").cast("string"), F.lit(".0")).alias("year"),
    )
    return tidy(
        rows.select(
            "o_orderkey",
            scalars.lenient_double("first").alias("digit"),
            scalars.lenient_double("o_orderpriority").alias("words"),
            scalars.lenient_int("year").alias("year_number"),
        )
    )


@query(
    "parse_date",
    """
SELECT o_orderkey, CASE WHEN left(o_orderpriority, 1) IN ('1', '2', '3')
  THEN strftime(o_orderdate, '%Y-%m-%d') END AS registered
FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The layout with and without a fraction, an ISO stamp, unreadable text and NULL."""
    kind = F.left("o_orderpriority", F.lit(1))
    day = F.col("o_orderdate")
    text = (
        F.when(kind == "1", F.date_format(day, "yyyy/M/d HH:mm:ss.SSSSSSSSS"))
        .when(kind == "2", F.date_format(day, "yyyy/M/d HH:mm:ss"))
        .when(kind == "3", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "4", F.lit("sem data"))
    )
    rows = table(spark, folder, "orders").select("o_orderkey", text.alias("text"))
    return tidy(rows.select("o_orderkey", scalars.parse_registration_date("text").alias("registered")))


@query(
    "trim_strings",
    "SELECT doc_id, lang, source, md5(trim(text)) AS text_md5, n_chars FROM documents",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    padded = table(spark, folder, "documents").withColumns(
        {
            "lang": F.concat(F.lit("  "), "lang"),
            "source": F.concat("source", F.lit("   ")),
            "text": F.concat(F.lit(" "), "text", F.lit(" ")),
        }
    )
    trimmed = align.trim_strings(padded)
    return tidy(trimmed.select("doc_id", "lang", "source", F.md5("text").alias("text_md5"), "n_chars"))


@query(
    "align_rename",
    """
SELECT l_orderkey AS order_id, l_quantity AS "quant pavimentos", l_tax AS "valor IPTU" FROM lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").alias("quantidade de pavimentos"),
        F.col("l_tax").alias(R.tax_value),
    )
    return tidy(align.rename_for_year(rows, 2024))


@query(
    "align_aliases",
    """
SELECT o_orderkey AS order_id, round(o_totalprice, 4) AS "valor IPTU" FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """A known spelling in other case and with a typo stands in for its column."""
    rows = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("Valor cobrado do IPTU ")
    )
    return tidy(align.align_aliases(rows))


@query(
    "align_missing",
    _ORDERS
    + f"""
SELECT entity AS "Número do contribuinte", ano AS {_ANO}, CAST(NULL AS VARCHAR) AS bairro,
       round(tax, 4) AS "valor IPTU", CAST(NULL AS DOUBLE) AS "AREA TERRENO", tipo_construcao AS extra
FROM records""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_records(spark, folder, R.entity, R.year, R.tax_value, R.construction_type)
    rows = rows.withColumnRenamed(R.construction_type, "extra")
    filled = align.fill_missing(rows, Spec().schema)
    return tidy(filled.select(R.entity, R.year, R.neighborhood, R.tax_value, R.land_area, "extra"))


@query(
    "align_year",
    _ORDERS
    + f"""
SELECT entity AS "Número do contribuinte", ano AS {_ANO}, strftime(registered, '%Y-%m-%d') AS "data do cadastramento",
       bairro, round(tax, 2) AS "valor IPTU", lpad(entity, 8, '0') AS "CEP",
       CAST(NULL AS DOUBLE) AS "AREA TERRENO"
FROM records""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """All alignment steps on text cells: names, types, blanks, postal codes."""
    rows = order_records(spark, folder, R.entity, R.year, R.registered, R.neighborhood, R.tax_value)
    price = F.replace(F.format_string("R$ %.2f", quoted(R.tax_value)), F.lit("."), F.lit(","))
    raw = rows.select(
        quoted(R.entity),
        quoted(R.year).cast("string").alias(R.year),
        F.date_format(quoted(R.registered), "yyyy/M/d HH:mm:ss.SSSSSSSSS").alias(R.registered),
        F.concat(F.lit(" "), quoted(R.neighborhood), F.lit("  ")).alias(R.neighborhood),
        price.alias("valor cobrado de IPTU"),
        quoted(R.entity).alias(R.postal_code),
    )
    aligned = align.align_year(raw, 2024)
    kept = [R.entity, R.year, R.registered, R.neighborhood, R.tax_value, R.postal_code, R.land_area]
    return tidy(aligned.select(*kept), 2)


@query(
    "audit_columns",
    """
SELECT o_orderkey, 'orders' AS _source_file, CAST(2024 AS BIGINT) AS _year_partition,
       'silver' AS _data_layer
FROM orders""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey")
    audited = align.add_silver_audit(align.add_bronze_audit(rows, 2024, "orders"))
    return tidy(audited.drop("_bronze_ingestion_timestamp", "_silver_timestamp"))


@query(
    "fuzzy_canonicalize",
    """
WITH dirty AS (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN lower(c_mktsegment) || 'X'
              WHEN c_custkey % 3 = 1 THEN left(c_mktsegment, length(c_mktsegment) - 2)
              ELSE ' ' || c_name END AS value FROM customer)
, counted AS (SELECT value, count(*) AS rows FROM dirty GROUP BY value)
, reference AS (SELECT * FROM (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'),
  ('MACHINERY')) t(canonical))
, scored AS (
  SELECT value, rows, canonical, round(1 - levenshtein(lower(trim(value)), lower(canonical))
    / greatest(length(trim(value)), length(canonical)), 6) AS score
  FROM counted, reference)
, best AS (SELECT *, row_number() OVER (PARTITION BY value ORDER BY score DESC, canonical) AS rn FROM scored)
SELECT value, rows, CASE WHEN score >= 0.7 THEN canonical END AS canonical,
       CASE WHEN score >= 0.7 THEN score END AS score
FROM best WHERE rn = 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Market segments with extra or lost letters, among unrelated names."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    dirty = (
        F.when(key % 3 == 0, F.concat(F.lower(segment), F.lit("X")))
        .when(key % 3 == 1, F.left(segment, F.length(segment) - 2))
        .otherwise(F.concat(F.lit(" "), "c_name"))
    )
    rows = table(spark, folder, "customer").select(dirty.alias("segment"))
    reference = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return tidy(align.canonicalize_values(rows, "segment", reference), 6)


# ---- set operations, incremental loading, export ----------------------------


@query(
    "union_years",
    """
SELECT CAST(year(o_orderdate) AS BIGINT) AS ano, o_totalprice AS valor, o_orderpriority AS tipo,
       CAST(NULL AS DOUBLE) AS area FROM orders
UNION ALL
SELECT CAST(year(l_shipdate) AS BIGINT), l_tax, NULL, l_quantity FROM lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("ano"),
        F.col("o_totalprice").alias("valor"),
        F.col("o_orderpriority").alias("tipo"),
    )
    lines = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("area"),
        F.col("l_tax").alias("valor"),
        F.year("l_shipdate").alias("ano"),
    )
    return tidy(align.union_years([orders, lines]))


_DAYS = "SELECT event_id, CAST(day(ts) AS BIGINT) AS day, event_type, value FROM events"


def _events_by_day(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Events as stored so far (days 1 to 15) and as they arrive (every day)."""
    events = table(spark, folder, "events").select(
        "event_id", F.day("ts").alias("day"), "event_type", "value"
    )
    return events.where(F.col("day") <= 15), events


@query("incremental_anti", _DAYS + " WHERE day(ts) > 15")
def _(spark: SparkSession, folder: str) -> DataFrame:
    stored, incoming = _events_by_day(spark, folder)
    return tidy(keep_new_keys(incoming, stored, "day"))


@query("incremental_append", _DAYS)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Appending the new days to the stored ones equals loading everything."""
    stored, incoming = _events_by_day(spark, folder)
    return tidy(align.append_years(stored, incoming, "day"))


@query(
    "dedup_rows",
    "SELECT DISTINCT md5(text) AS text_md5, lang FROM documents",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = export.distinct_rows(table(spark, folder, "documents").select("text", "lang"))
    return rows.select(F.md5("text").alias("text_md5"), "lang")


@query(
    "export_refined",
    """
SELECT DISTINCT l_partkey AS _id, strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_returnflag
FROM lineitem""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("_id"),
        F.col("l_shipdate").alias("shipped"),
        "l_returnflag",
        F.lit("bronze").alias("_data_layer"),
    )
    return tidy(export.refined(rows))


_PRESENCE_YEARS = list(range(1995, 2002))
_PRESENCE_FLAGS = ", ".join(
    f'coalesce(bool_or(ano = {y}), false) AS "In_{y}"' for y in _PRESENCE_YEARS
)


def _name_rows(spark: SparkSession, folder: str) -> DataFrame:
    return order_records(spark, folder, R.year, R.entity).toDF("ano", "name")


@query(
    "column_presence",
    _ORDERS + f"SELECT entity AS name, {_PRESENCE_FLAGS} FROM records GROUP BY entity",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return profile.presence_matrix(_name_rows(spark, folder), "ano", "name", _PRESENCE_YEARS)


@query(
    "column_diff",
    _ORDERS
    + """
, names AS (SELECT DISTINCT entity AS name, ano FROM records)
, every AS (SELECT DISTINCT name FROM names)
, later AS (SELECT unnest(range(1996, 2002)) AS ano)
SELECT CAST(ano AS BIGINT) AS ano, name, CASE WHEN in_base THEN '1995' ELSE CAST(ano AS VARCHAR) END AS only_in
FROM (
  SELECT l.ano, e.name,
    EXISTS (SELECT 1 FROM names n WHERE n.name = e.name AND n.ano = 1995) AS in_base,
    EXISTS (SELECT 1 FROM names n WHERE n.name = e.name AND n.ano = l.ano) AS in_later
  FROM later l, every e)
WHERE in_base <> in_later""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _name_rows(spark, folder)
    return tidy(profile.presence_differences(rows, "ano", "name", _PRESENCE_YEARS))


# ---- reshapes ----------------------------------------------------------------

_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_PRIORITY_PIVOT = "SELECT ano, " + ", ".join(
    f"count(*) FILTER (tipo_uso = '{p}') AS \"{p}\"" for p in _PRIORITIES
) + " FROM records GROUP BY ano"


@query("pivot_year_type", _ORDERS + _PRIORITY_PIVOT)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(reshape.pivot_year_type(order_records(spark, folder, R.year, R.use_type)))


@query("pivot_top5_types", _ORDERS + _PRIORITY_PIVOT)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(reshape.pivot_top_types(order_records(spark, folder, R.year, R.use_type)))


@query(
    "neighborhood_heatmap",
    _ORDERS
    + _TOP_PER_YEAR
    + "SELECT bairro, "
    + ", ".join(
        f'CAST(coalesce(sum(quantidade) FILTER (ano = {y}), 0) AS BIGINT) AS "{y}"'
        for y in _PRESENCE_YEARS
    )
    + " FROM top GROUP BY bairro",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(reshape.neighborhood_heatmap(order_counts(spark, folder, R.year, R.neighborhood)))


_FENCED = """
, quartiles AS (SELECT ano, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3
  FROM prices GROUP BY ano)
, fenced AS (SELECT p.*, q1 - (q3 - q1) * 3 AS fence_low, q3 + (q3 - q1) * 3 AS fence_high
  FROM prices p JOIN quartiles q ON p.ano = q.ano
  WHERE v BETWEEN q1 - (q3 - q1) * 3 AND q3 + (q3 - q1) * 3)
"""
_SPIKED_LINES = """
WITH prices AS (
  SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
         CAST(year(l_shipdate) AS BIGINT) AS ano,
         CASE WHEN l_quantity = 50 AND l_discount = 0 THEN l_extendedprice * 100
              ELSE l_extendedprice END AS v
  FROM lineitem)
"""


def _spiked_lines(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    """Line prices with some outliers a hundred times too great."""
    price = F.col("l_extendedprice")
    spike = (F.col("l_quantity") == 50) & (F.col("l_discount") == 0)
    return table(spark, folder, "lineitem").select(
        *names,
        F.year("l_shipdate").alias("ano"),
        F.when(spike, price * 100).otherwise(price).alias("v"),
    )


@query(
    "iqr_fence",
    _SPIKED_LINES
    + _FENCED
    + "SELECT l_orderkey, l_linenumber, ano, round(v, 4) AS v, round(fence_low, 4) AS fence_low,"
    + " round(fence_high, 4) AS fence_high FROM fenced",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _spiked_lines(spark, folder, "l_orderkey", "l_linenumber")
    return tidy(reshape.within_fences(rows, "ano", F.col("v")))


@query(
    "boxplot_by_year",
    _SPIKED_LINES
    + _FENCED
    + """
SELECT ano, count(*) AS n, round(min(v), 4) AS minimo, round(quantile_cont(v, 0.25), 4) AS q1,
       round(median(v), 4) AS mediana, round(quantile_cont(v, 0.75), 4) AS q3,
       round(max(v), 4) AS maximo
FROM fenced GROUP BY ano""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _spiked_lines(spark, folder).toDF(R.year, R.tax_value)
    return tidy(reshape.boxplot_by_year(rows))


@query(
    "log_scale_flag",
    _SPIKED_LINES
    + """
SELECT round(max(v), 4) AS maximo, round(median(v), 4) AS mediana, max(v) > median(v) * 50 AS use_log
FROM prices WHERE v > 0""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = _spiked_lines(spark, folder).toDF(R.year, R.tax_value)
    return tidy(reshape.log_scale_flag(rows))


_REPORT_TOP = """
, types AS (SELECT 'tipo_uso' AS section, tipo_uso AS label, count(*) AS total_imoveis
  FROM records GROUP BY tipo_uso ORDER BY count(*) DESC, tipo_uso LIMIT 10)
, places AS (SELECT 'bairro' AS section, bairro AS label, count(*) AS total_imoveis
  FROM records GROUP BY bairro ORDER BY count(*) DESC, bairro LIMIT 10)
, top AS (SELECT *, round(total_imoveis / (SELECT count(*) FROM records) * 100, 2) AS percentual
  FROM (SELECT * FROM types UNION ALL SELECT * FROM places))
"""


@query("report_top10", _ORDERS + _REPORT_TOP + "SELECT * FROM top")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_counts(spark, folder, R.use_type, R.neighborhood)
    return tidy(reshape.report_top(volume.volume_by_type(rows), volume.volume_by_neighborhood(rows)))


@query(
    "summary_report_rows",
    _ORDERS
    + _REPORT_TOP
    + """
SELECT 'total' AS section, 'total' AS label, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS DOUBLE) AS extra
FROM records
UNION ALL SELECT 'ano', CAST(ano AS VARCHAR), CAST(count(*) AS DOUBLE), NULL FROM records GROUP BY ano
UNION ALL SELECT section, label, CAST(total_imoveis AS DOUBLE), percentual FROM top
UNION ALL SELECT 'tendencia', CAST(ano AS VARCHAR), round(avg(tax), 4), round(median(tax), 4)
FROM records WHERE tax > 0 GROUP BY ano""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_counts(spark, folder, R.year, R.use_type, R.neighborhood)
    report = reshape.summary_report_rows(
        volume.total_properties(rows),
        volume.volume_by_year(rows),
        volume.volume_by_type(rows),
        volume.volume_by_neighborhood(rows),
        value.tax_stats_by_year(order_records(spark, folder, R.year, R.tax_value)),
    )
    return tidy(report)


# ---- profiles ------------------------------------------------------------------


@query(
    "low_cardinality",
    _ORDERS
    + """
, counts AS (
  SELECT 'Número do contribuinte' AS column, count(DISTINCT entity) AS distinct_count FROM records
  UNION ALL SELECT 'tipo de uso do imóvel', count(DISTINCT tipo_uso) FROM records
  UNION ALL SELECT 'Tipo de Construção', count(DISTINCT tipo_construcao) FROM records
  UNION ALL SELECT 'bairro', count(DISTINCT bairro) FROM records)
SELECT * FROM counts WHERE distinct_count < 50""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_records(
        spark, folder, R.entity, R.use_type, R.construction_type, R.neighborhood, R.tax_value
    )
    return tidy(profile.low_cardinality(rows))


def _summary_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column, count({column}) AS count, round(avg({column}), 4) AS mean,
  round(stddev({column}), 4) AS std, CAST(round(min({column}), 4) AS DOUBLE) AS min,
  round(quantile_cont({column}, 0.25), 4) AS p25, round(median({column}), 4) AS p50,
  round(quantile_cont({column}, 0.75), 4) AS p75, CAST(round(max({column}), 4) AS DOUBLE) AS max
FROM lineitem"""


_SUMMARY_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("numeric_summary", "\nUNION ALL ".join(_summary_sql(c) for c in _SUMMARY_COLUMNS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(*_SUMMARY_COLUMNS)
    return tidy(profile.numeric_summary(rows))


@query(
    "categorical_top_values",
    """
WITH long AS (
  SELECT 'o_orderpriority' AS "column", o_orderpriority AS value FROM orders
  UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders
  UNION ALL SELECT 'customer', CAST(o_custkey AS VARCHAR) FROM orders)
, counts AS (SELECT "column", value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)
, ranked AS (SELECT *, count(*) OVER (PARTITION BY "column") AS distinct_count,
    row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM counts)
SELECT "column", distinct_count, rank, value, n FROM ranked
WHERE rank <= CASE WHEN distinct_count <= 20 THEN 10 ELSE 5 END""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_orderpriority", "o_orderstatus", F.col("o_custkey").cast("string").alias("customer")
    )
    return tidy(profile.categorical_top_values(rows))


@query(
    "dataset_overview",
    """
WITH rows_in AS (SELECT text, lang, source, quality, toxic
  FROM documents LEFT JOIN labels USING (doc_id))
, copies AS (SELECT *, count(*) AS n FROM rows_in GROUP BY ALL)
SELECT lang, CAST(sum(n) AS BIGINT) AS rows,
       CAST(sum(n * ((text IS NULL)::INT + (source IS NULL)::INT + (quality IS NULL)::INT
         + (toxic IS NULL)::INT)) AS BIGINT) AS missing_cells,
       CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM copies GROUP BY lang""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled_documents(spark, folder).select("text", "lang", "source", "quality", "toxic")
    return tidy(profile.dataset_overview(rows, "lang"))


# ---- quality -------------------------------------------------------------------


@query(
    "dq_structure",
    "SELECT count(*) AS row_count, CAST(5 AS BIGINT) AS column_count, count(*) > 0 AS passed FROM documents",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(quality.structure(table(spark, folder, "documents")))


@query(
    "dq_min_rows",
    _ORDERS + "SELECT ano AS year, count(*) AS row_count, count(*) >= 2000 AS passed FROM records GROUP BY ano",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(quality.min_rows_by_year(order_records(spark, folder, R.year), R.year, 2000))


_LABELLED = "WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))\n"


def _null_sql(columns: list[str]) -> str:
    return _LABELLED + "\nUNION ALL ".join(
        f"SELECT count(*) AS rows, '{c}' AS column, count(*) - count({c}) AS null_count, "
        f"round((count(*) - count({c})) / count(*) * 100, 2) AS null_pct FROM d"
        for c in columns
    )


_LABELLED_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@query("dq_null_profile", _null_sql(_LABELLED_COLUMNS))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.null_profile(labelled_documents(spark, folder)))


@query(
    "high_null_columns",
    "SELECT * FROM (" + _null_sql(_LABELLED_COLUMNS) + ") WHERE null_count * 100.0 / rows > 50",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.high_null_columns(labelled_documents(spark, folder)))


@query(
    "dq_duplicate_keys",
    """
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (n > 1) AS duplicate_keys,
       round(count(*) FILTER (n > 1) / sum(n) * 100, 2) AS duplicate_pct
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    return tidy(profile.duplicate_keys(rows, ["l_orderkey", "l_linenumber"]))


@query(
    "dq_duplicate_rows",
    """
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) FILTER (n > 1) AS duplicate_groups,
       CAST(sum(n - 1) AS BIGINT) AS excess_rows
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.duplicate_rows(table(spark, folder, "documents").select("text", "lang")))


@query(
    "dq_types",
    """
SELECT count(*) AS rows, 'props' AS column, 'string' AS declared, 'double' AS expected,
       count(*) FILTER (props IS NOT NULL AND TRY_CAST(props AS DOUBLE) IS NULL) AS failing,
       count(*) FILTER (props IS NOT NULL AND TRY_CAST(props AS DOUBLE) IS NULL) = 0 AS passed FROM events
UNION ALL SELECT count(*), 'user_id', 'bigint', 'bigint', 0, true FROM events
UNION ALL SELECT count(*), 'event_type', 'string', 'int',
       count(*) FILTER (TRY_CAST(event_type AS INTEGER) IS NULL),
       count(*) FILTER (TRY_CAST(event_type AS INTEGER) IS NULL) = 0 FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    expected = {"props": "double", "user_id": "bigint", "event_type": "int"}
    return tidy(quality.type_checks(table(spark, folder, "events"), expected))


@query(
    "dq_year_consistency",
    """
SELECT CAST(year(o_orderdate) AS BIGINT) AS expected_year, count(*) AS row_count,
       count(*) FILTER (year(l_shipdate) <> year(o_orderdate)) AS wrong_year_rows,
       count(*) FILTER (year(l_shipdate) <> year(o_orderdate)) = 0 AS passed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Lines are expected to ship in the year of their order."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    checked = quality.year_consistency(joined, F.year("l_shipdate"), F.year("o_orderdate"))
    return tidy(checked)


@query(
    "dq_years_present",
    _ORDERS
    + """SELECT ano AS year, count(*) AS row_count, (SELECT count(DISTINCT ano) FROM records) AS year_count
FROM records GROUP BY ano""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(quality.years_present(order_records(spark, folder, R.year), R.year))


_CODES = """
WITH codes AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
  WHEN c_mktsegment = 'MACHINERY' THEN right(c_name, 7) WHEN c_mktsegment = 'HOUSEHOLD' THEN c_name
  ELSE right(c_name, 8) END AS code FROM customer)
"""


def _codes(spark: SparkSession, folder: str) -> DataFrame:
    """Eight digits, seven digits, letters and NULL, by market segment."""
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    code = (
        F.when(segment == "BUILDING", F.lit(None))
        .when(segment == "MACHINERY", F.right(name, F.lit(7)))
        .when(segment == "HOUSEHOLD", name)
        .otherwise(F.right(name, F.lit(8)))
    )
    return table(spark, folder, "customer").select("c_custkey", code.alias("code"))


@query(
    "rule_postal_code",
    _CODES + "SELECT c_custkey, code IS NULL OR regexp_full_match(code, '[0-9]{8}') AS ok FROM codes",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _codes(spark, folder).select("c_custkey", scalars.is_postal_code_ok("code").alias("ok"))


_REPORT = ["layer", "scope", "check", "severity", "passed", "metric"]


def _report_sql(records: str, layer: str, rows: list[tuple[str, str, str, str]], scope: str = "'all'") -> str:
    """Report rows as SQL: (check, severity, metric, condition on m)."""
    return records + "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, {scope} AS scope, '{check}' AS \"check\", '{severity}' AS severity, "
        f"({condition}) AS passed, round(CAST(m AS DOUBLE), 4) AS metric FROM (SELECT {metric} AS m FROM t)"
        for check, severity, metric, condition in rows
    )


def _one_rule(df: DataFrame, rule: quality.Rule) -> DataFrame:
    return tidy(quality.run_rules(df, [rule], "silver").select(*_REPORT))


@query(
    "dq_postal_code",
    _report_sql(
        _CODES + ", t AS (SELECT * FROM codes) ", "silver",
        [("postal_code", "WARNING",
          "count(*) FILTER (code IS NOT NULL AND NOT regexp_full_match(code, '[0-9]{8}'))", "m = 0")],
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return _one_rule(_codes(spark, folder), quality.postal_code_rule("code"))


@query(
    "dq_domain_upper",
    _report_sql(
        "WITH t AS (SELECT * FROM documents) ", "silver",
        [("domain:lang", "WARNING", "count(*) FILTER (upper(trim(lang)) NOT IN ('EN', 'DE', 'FR'))", "m = 0")],
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    domain = Domain("lang", ("EN", "DE", "FR"))
    return _one_rule(table(spark, folder, "documents"), quality.domain_rule(domain))


@query(
    "dq_domain",
    _report_sql(
        "WITH t AS (SELECT * FROM lineitem) ", "silver",
        [("domain:l_returnflag", "WARNING", "count(*) FILTER (l_returnflag NOT IN ('A', 'N', 'R'))", "m = 0")],
    ),
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    domain = Domain("l_returnflag", ("A", "N", "R"))
    return _one_rule(table(spark, folder, "lineitem"), quality.domain_rule(domain))


_SILVER_ROLES = Roles(entity="o_custkey", year="year", postal_code="clerk")
_SILVER_SPEC = Spec(roles=_SILVER_ROLES, domains=(Domain("o_orderstatus", ("F", "O")),))


def _silver_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").withColumns(
        {"year": F.year("o_orderdate"), "clerk": F.lpad(F.col("o_orderkey").cast("string"), 8, "0")}
    )


_SILVER_RULES = [
    ("not_empty", "ERROR", "count(*)", "m > 0"),
    ("years_present", "WARNING", "count(DISTINCT year(o_orderdate))", "m > 0"),
    ("postal_code", "WARNING", "count(*) FILTER (false)", "m = 0"),
    ("domain:o_orderstatus", "WARNING", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))", "m = 0"),
    ("custom:dear_orders", "INFO", "count(*) FILTER (o_totalprice > 400000)", "true"),
]


def _silver_sql() -> str:
    keys = """(SELECT count(*) FROM (SELECT 1 FROM orders
  GROUP BY o_custkey, year(o_orderdate) HAVING count(*) > 1))"""
    rules = _SILVER_RULES + [("unique_keys", "WARNING", f"max({keys})", "m = 0")]
    rows = _report_sql("WITH t AS (SELECT * FROM orders) ", "silver", rules)
    return rows + """
UNION ALL SELECT 'silver', 'all', 'custom:unknown_column', 'WARNING', false, NULL"""


@query("dq_custom", _silver_sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The consolidated checks with two custom rules, one of which cannot run."""
    custom = {
        "dear_orders": lambda df: F.count_if(df["o_totalprice"] > 400000),
        "unknown_column": lambda df: F.sum(F.col("no_such_column")),
    }
    report = quality.validate_silver(_silver_orders(spark, folder), _SILVER_SPEC, custom)
    return tidy(report.select(*_REPORT))


def _gold_sql(columns: list[str]) -> str:
    summary = f"""WITH g AS (SELECT s_nationkey, quality, count(*) AS n
  FROM supplier LEFT JOIN labels ON s_suppkey = doc_id GROUP BY 1, 2)
, t AS (SELECT * FROM g) """
    rows = [("row_count", "INFO", "count(*)", "true")]
    rows += [
        (f"nulls:{c}", "WARNING", f"count(*) FILTER ({c} IS NULL) * 100.0 / count(*)", "m <= 20")
        for c in columns
    ]
    rows.append(("no_duplicates", "ERROR", "count(*) FILTER (false)", "m = 0"))
    return _report_sql(summary, "gold_by_nation", rows)


def _gold_table(spark: SparkSession, folder: str) -> DataFrame:
    suppliers, labels = table(spark, folder, "supplier"), table(spark, folder, "labels")
    joined = suppliers.join(labels, F.col("s_suppkey") == F.col("doc_id"), "left")
    return joined.groupBy("s_nationkey", "quality").agg(F.count(F.lit(1)).alias("n"))


@query("dq_gold_nulls", _gold_sql(["s_nationkey", "quality", "n"]))
def _(spark: SparkSession, folder: str) -> DataFrame:
    report = quality.validate_gold(_gold_table(spark, folder), "by_nation")
    return tidy(report.select(*_REPORT))


@query(
    "dq_gold_duplicates",
    """
SELECT 'gold_lines' AS layer, 'no_duplicates' AS "check", 'ERROR' AS severity, count(*) = 0 AS passed,
       CAST(count(*) AS DOUBLE) AS metric
FROM (SELECT 1 FROM lineitem GROUP BY l_partkey, l_quantity HAVING count(*) > 1)""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_partkey", "l_quantity")
    report = quality.validate_gold(rows, "lines").where(F.col("check") == "no_duplicates")
    return tidy(report.select("layer", "check", "severity", "passed", "metric"))


@query(
    "dq_row_conservation",
    _ORDERS
    + """
, after AS (SELECT ano, count(*) AS n FROM records WHERE bairro IS NOT NULL AND property_value > 0 GROUP BY ano)
SELECT b.ano AS year, b.n AS rows_before, coalesce(a.n, 0) AS rows_after, b.n = coalesce(a.n, 0) AS passed
FROM (SELECT ano, count(*) AS n FROM records GROUP BY ano) b LEFT JOIN after a ON a.ano = b.ano""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    before = order_records(spark, folder, R.year, R.neighborhood, R.property_value)
    after = before.where(quoted(R.neighborhood).isNotNull() & (quoted(R.property_value) > 0))
    return tidy(quality.row_conservation(before, after, R.year))


_YEAR_RULES = (
    _ORDERS
    + """
, report AS (
  SELECT ano, count(*) AS row_count, count(*) < 2000 AS few, count(*) FILTER (tipo_uso = '5-LOW') AS low,
         count(*) FILTER (property_value < 0) AS negative
  FROM records GROUP BY ano)
, scopes AS (SELECT 'silver' AS layer, CAST(ano AS VARCHAR) AS scope, row_count,
    CAST(few AS BIGINT) AS errors_count,
    CAST(low > 0 AS BIGINT) + CAST(negative > 0 AS BIGINT) AS warnings_count, NOT few AS passed FROM report)
"""
)


def _year_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = order_records(spark, folder, R.year, R.use_type, R.property_value)
    negative = f"count_if({sqltext.name(R.property_value)} < 0)"
    rules = [
        quality.rows_rule(),
        quality.min_rows_rule(2000, quality.ERROR),
        quality.domain_rule(Domain(R.use_type, tuple(_PRIORITIES[:-1]))),
        quality.Rule("no_negative_value", quality.WARNING, negative),
    ]
    return quality.run_rules(rows, rules, "silver", quoted(R.year))


@query("dq_report", _YEAR_RULES + "SELECT * FROM scopes")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(quality.scope_results(_year_report(spark, folder)))


@query(
    "dq_findings",
    _YEAR_RULES
    + """
SELECT 'silver' AS layer, CAST(ano AS VARCHAR) AS scope, 'ERROR' AS severity, 'min_rows' AS "check",
       CAST(row_count AS DOUBLE) AS metric FROM report WHERE few
UNION ALL SELECT 'silver', CAST(ano AS VARCHAR), 'WARNING', 'domain:tipo de uso do imóvel', CAST(low AS DOUBLE)
FROM report WHERE low > 0
UNION ALL SELECT 'silver', CAST(ano AS VARCHAR), 'WARNING', 'no_negative_value', CAST(negative AS DOUBLE)
FROM report WHERE negative > 0""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(quality.findings(_year_report(spark, folder)).drop("detail"))


@query(
    "dq_summary",
    _YEAR_RULES
    + """
SELECT count(*) AS total_validations, count(*) FILTER (passed) AS passed,
       count(*) FILTER (NOT passed) AS failed,
       round(count(*) FILTER (passed) * 100.0 / count(*), 4) AS success_rate FROM scopes""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(quality.summary(_year_report(spark, folder)))


@query(
    "dq_empty_strings",
    """
SELECT count(*) AS rows, 'props' AS column, count(*) FILTER (event_type = 'error') AS empty_count,
       round(count(*) FILTER (event_type = 'error') / count(*) * 100, 2) AS empty_pct FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    props = F.when(F.col("event_type") == "error", "").otherwise(F.col("props"))
    return tidy(profile.empty_string_counts(table(spark, folder, "events").withColumn("props", props)))


@query(
    "dq_id_candidates",
    """
SELECT 'event_id' AS column, count(DISTINCT event_id) AS distinct_count, count(*) AS rows FROM events
UNION ALL SELECT 'user_id', count(DISTINCT user_id), count(*) FROM events""",
)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return tidy(profile.id_candidates(table(spark, folder, "events")))
