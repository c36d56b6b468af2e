from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.operators import age, evolution, gold, reshape, value, volume
from strata.plans.registry import ANALYSES, Options, available, build_all, counts_for
from strata.spec import ROLES as R
from tests.conftest import rows


def records(spark, data):
    """(year, neighbourhood, use type, tax text) records."""
    schema = f"`{R.year}` int, `{R.neighborhood}` string, `{R.use_type}` string, `{R.tax_value}` string"
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="module")
def small(spark):
    data = [
        (2020, "A", "RES", "R$ 10,0"), (2020, "A", "RES", "0"), (2020, "B", "COM", "x"),
        (2021, "A", "RES", "0"), (2021, None, "RES", "0"), (2022, "B", None, "30"),
        (2022, "B", "COM", "20"), (2022, "A", "RES", "5"), (2022, "A", "RES", "1"),
    ]
    return records(spark, data)


def test_total_and_yearly_counts_agree(small):
    total = volume.total_properties(small).first()
    assert tuple(total) == ("Total de Imóveis", 9)
    by_year = rows(volume.volume_by_year(small))
    assert by_year == [(2020, 3), (2021, 2), (2022, 4)]
    assert sum(n for _, n in by_year) == 9


def test_null_keys_are_a_group_unless_dropped(small):
    kept = {r["tipo_uso"]: (r["total_imoveis"], r["percentual"]) for r in volume.volume_by_type(small).collect()}
    assert kept == {"RES": (6, 66.67), "COM": (2, 22.22), None: (1, 11.11)}
    dropped = rows(volume.volume_by_type(small, drop_null_keys=True))
    assert dropped == [("COM", 2, 22.22), ("RES", 6, 66.67)]


def test_shares_sum_to_a_hundred(small):
    for build in (volume.volume_by_neighborhood, volume.distribution_by_year):
        assert sum(r["percentual"] for r in build(small).collect()) == pytest.approx(100, abs=0.05)


def test_share_of_top_is_of_all_rows(spark):
    df = records(spark, [(2020, f"N{i:02}", "R", "1") for i in range(30)])
    top = volume.distribution_by_neighborhood_top(df)
    assert rows(top, "bairro") == [(f"N{i:02}",) for i in range(20)]
    assert {r["percentual"] for r in top.collect()} == {3.33}


def test_ties_at_rank_ten_go_by_name(spark):
    data = [(y, f"N{i:02}", "R", "1") for y in (2020, 2021) for i in range(15)]
    data += [(2021, "N14", "R", "1")]
    got = rows(volume.top_neighborhoods_by_year(records(spark, data)), "ano", "bairro")
    assert [b for y, b in got if y == 2020] == [f"N{i:02}" for i in range(10)]
    assert [b for y, b in got if y == 2021] == [f"N{i:02}" for i in range(9)] + ["N14"]


def test_tax_stats_split_zeros(small):
    got = rows(value.tax_stats_by_year(small))
    assert got == [
        (2020, 10.0, 10.0, 10.0, 10.0, 10.0, 2, 1),
        (2021, None, None, None, None, 0.0, 2, 0),
        (2022, 14.0, 12.5, 1.0, 30.0, 56.0, 4, 4),
    ]
    filled = rows(value.tax_stats_by_year(small, fill_zero=True))
    assert filled[1] == (2021, 0.0, 0.0, 0.0, 0.0, 0.0, 2, 0)
    assert rows(value.tax_stats_by_year_joined(small)) == got


def test_tax_stats_when_nothing_is_above_zero(spark):
    df = records(spark, [(2020, "A", "R", "0"), (2020, "A", "R", "-4"), (2021, "A", "R", "0")])
    assert rows(value.tax_stats_by_year(df)) == [
        (2020, -2.0, -2.0, -4.0, 0.0, -4.0, 2, 0), (2021, 0.0, 0.0, 0.0, 0.0, 0.0, 1, 0),
    ]


def test_approximate_median_is_an_observed_value(small):
    approx = {r["ano"]: r["mediana"] for r in value.tax_stats_by_year(small, approximate=True).collect()}
    assert approx[2022] in (5.0, 20.0)


def test_mean_tax_by_place_includes_zeros(small):
    got = {r["bairro"]: (r["media"], r["count"]) for r in value.avg_tax_by_neighborhood_top(small).collect()}
    assert got == {"A": (3.2, 5), "B": (25.0, 2), None: (0.0, 1)}


def test_property_value_counts_rows(spark):
    df = spark.createDataFrame(
        [(2020, "R$ 1,0"), (2020, "n/d"), (2020, "4")], f"`{R.year}` int, `{R.property_value}` string"
    )
    assert rows(value.property_value_by_year(df)) == [(2020, 2.5, 2.5, 5.0, 3)]


def built(spark, years, taxes=None):
    taxes = taxes or ["10"] * len(years)
    return spark.createDataFrame(
        list(zip(years, taxes)), f"`{R.built_year}` string, `{R.tax_value}` string"
    )


def test_age_filters_and_bands(spark):
    df = built(spark, ["2010", "2000", "1959", "0", None, "2021", "x", "2020"])
    got = {r["faixa_idade"]: (r["quantidade"], r["percentual"], r["ordem"])
           for r in age.age_distribution(df, 2020).collect()}
    assert got == {"0-10 anos": (2, 50.0, 1), "11-20 anos": (1, 25.0, 2), "60+ anos": (1, 25.0, 7)}


def test_age_statistics(spark):
    df = built(spark, ["2010", "2000", "1990", "1980"])
    assert tuple(age.age_statistics(df, 2020).first()) == (25.0, 25.0, 10, 40)
    assert rows(age.age_statistics_long(df, 2020)) == [
        ("maximo", 40.0), ("media", 25.0), ("mediana", 25.0), ("minimo", 10.0),
    ]
    assert tuple(age.age_statistics(df.limit(0), 2020).first()) == (None, None, None, None)


def test_age_value_drops_future_years_and_zero_tax(spark):
    df = built(spark, ["2015", "2030", "1950", "1950"], ["4", "100", "0", "7"])
    got = rows(age.age_value_relationship(df, 2020), "faixa_idade", "valor_medio", "quantidade")
    assert got == [("0-10", 4.0, 1), ("50+", 7.0, 1)]


def growth_rows(spark):
    def many(year, place, n, tax):
        return [(year, place, "R", tax)] * n

    data = (
        many(2020, "UP", 11, "10") + many(2022, "UP", 22, "15")
        + many(2020, "DOWN", 20, "10") + many(2022, "DOWN", 10, "5")
        + many(2020, "FEW", 10, "1") + many(2022, "FEW", 50, "1")
        + many(2020, "GONE", 12, "1") + many(2022, "NEW", 12, "1")
        + many(2021, "UP", 3, "1") + many(2024, "UP", 99, "1") + many(2020, "ZERO", 30, "0")
    )
    return records(spark, data)


def test_evolution(spark):
    df = growth_rows(spark)
    want = [
        ("DOWN", 20, 10.0, 10, 5.0, -50.0, -50.0), ("UP", 11, 10.0, 22, 15.0, 100.0, 50.0),
    ]
    assert rows(evolution.neighborhood_evolution(df)) == want
    assert rows(evolution.neighborhood_evolution_joined(df)) == want
    grown = evolution.neighborhood_evolution(df)
    assert rows(evolution.top_growth_quantity(grown, 1), "bairro") == [("UP",)]
    assert rows(evolution.top_growth_value(grown, 1), "bairro") == [("UP",)]
    assert rows(evolution.growth_positive_or_worst(grown), "bairro") == [("UP",)]


def test_evolution_needs_two_years(spark):
    df = growth_rows(spark).where(F.col(R.year).isin(2020, 2024))
    assert evolution.neighborhood_evolution(df).count() == 0
    assert evolution.neighborhood_evolution_joined(df).count() == 0


def test_no_growth_shows_the_smallest_values(spark):
    shrunk = spark.createDataFrame(
        [("A", -5.0), ("B", -50.0), ("C", 0.0)], "bairro string, crescimento_quantidade double"
    )
    worst = evolution.growth_positive_or_worst(shrunk, k=2)
    assert [r["bairro"] for r in worst.collect()] == ["B", "A"]


def test_gold_parses_text_before_aggregating(small):
    got = {(r[0], r[1]): tuple(r)[2:] for r in gold.summary_by_year_type(small).collect()}
    assert got[(2020, "RES")] == (2, 10.0, 5.0, 0.0, 10.0)
    assert got[(2020, "COM")] == (1, None, None, None, None)
    assert got[(2022, "RES")] == (2, 6.0, 3.0, 1.0, 5.0)
    stamped = gold.stamped(small, "full")
    assert stamped.columns[-2:] == ["_gold_timestamp", "_output_type"]


def test_pivots_fill_with_zero(small):
    got = reshape.pivot_year_type(small)
    assert got.columns == ["ano", "COM", "RES"]
    assert rows(got) == [(2020, 1, 2), (2021, 0, 2), (2022, 1, 2)]
    assert reshape.pivot_top_types(small, k=1).columns == ["ano", "RES"]
    assert rows(reshape.neighborhood_heatmap(small)) == [
        ("A", 2, 1, 2), ("B", 1, 0, 2), (None, 0, 1, 0),
    ]


def test_fences_drop_an_outlier_and_keep_equal_values(spark):
    df = spark.createDataFrame(
        [(2020, 5.0)] * 9 + [(2020, 1000.0)] + [(2021, float(v)) for v in range(10)] + [(2021, 500.0)],
        "ano int, v double",
    )
    kept = rows(reshape.within_fences(df, "ano", F.col("v")), "ano", "v")
    assert kept == [(2020, 5.0)] * 9 + [(2021, float(v)) for v in range(10)]


def test_boxplot_and_log_scale(spark):
    df = records(spark, [(2020, "A", "R", str(v)) for v in [0, 1, 2, 3, 4, 10_000]])
    assert rows(reshape.boxplot_by_year(df)) == [(2020, 4, 1.0, 1.75, 2.5, 3.25, 4.0)]
    assert tuple(reshape.log_scale_flag(df).first()) == (10_000.0, 3.0, True)
    assert tuple(reshape.log_scale_flag(df.limit(0)).first()) == (None, None, False)


def test_summary_rows_hold_every_section(small):
    from strata.plans.registry import REPORTS

    made = build_all(small, Options(reference_year=2024), analyses=ANALYSES + REPORTS)
    report = made["summary_report"]
    sections = {r["section"] for r in report.select("section").distinct().collect()}
    assert sections == {"total", "ano", "tipo_uso", "bairro", "tendencia"}
    assert ("total", "total", 9.0, None) in rows(report)


def test_counted_input_gives_the_same_outputs(spark, small):
    options = Options(reference_year=2024)
    ages = built(spark, ["2010", "2000", "1990", "1990", "0", None])
    for df in (small, ages):
        for analysis in available(df):
            if analysis.counts_over:
                counts = counts_for(df, R, analysis.counts_over)
                if counts.columns == ["__rows"]:
                    continue
                direct = analysis.make(df, R, options, {})
                assert rows(analysis.make(counts, R, options, {})) == rows(direct)
    assert volume.total_properties(counts_for(small.limit(0), R, ("year",))).first()["value"] == 0


def test_registry_skips_what_the_columns_do_not_allow(spark, small):
    options = Options(reference_year=2024)
    built_names = set(build_all(small, options))
    assert "volume_by_type" in built_names and "age_statistics" not in built_names
    assert len(ANALYSES) == 20
    years_only = small.select(R.year)
    assert set(build_all(years_only, options)) == {
        "total_properties", "volume_by_year", "distribution_by_year",
    }
