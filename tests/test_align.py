from __future__ import annotations

import datetime as dt

import pytest

from strata.operators import align
from strata.operators.align import SchemaError
from strata.spec import CANONICAL_COLUMNS, KNOWN_ALIASES, ROLES as R, Spec
from tests.conftest import rows


def test_rename_applies_to_its_year_only(spark):
    df = spark.createDataFrame([("2",)], ["quantidade de pavimentos"])
    assert align.rename_for_year(df, 2024).columns == ["quant pavimentos"]
    assert align.rename_for_year(df, 2023).columns == ["quantidade de pavimentos"]


def test_aliases_ignore_case_blanks_and_a_typo():
    targets = [name for name, _ in CANONICAL_COLUMNS]
    for source in ["valor cobrado de IPTU", " VALOR COBRADO DE IPTU", "valor cobrado do IPTU"]:
        assert align.match_aliases([source], targets) == {source: "valor IPTU"}
    assert align.match_aliases(["valor"], targets) == {}


def test_alias_is_not_used_when_the_column_exists(spark):
    df = spark.createDataFrame([("1", "2")], ["valor IPTU", "valor cobrado de IPTU"])
    assert align.align_aliases(df).columns == df.columns


def test_similar_names_use_each_target_once():
    matches = align.match_similar_names(["bairo", "bairos", "cidade"], ["bairro", "cidade"])
    assert list(matches) == ["bairo"]
    assert matches["bairo"][0] == "bairro"
    assert matches["bairo"][1] == pytest.approx(10 / 11)


def test_similar_names_prefer_aliases_and_respect_threshold():
    sources = ["valor cobrado de IPTU", "valor iptu 2", "xyz"]
    matches = align.match_similar_names(sources, ["valor IPTU"], aliases=KNOWN_ALIASES)
    assert matches == {"valor cobrado de IPTU": ("valor IPTU", 1.0)}
    assert align.match_similar_names(["abc"], ["xyz"], threshold=0.7) == {}


def test_missing_columns_are_typed_and_extras_stay(spark):
    df = spark.createDataFrame([("A", "x")], ["bairro", "novidade"])
    filled = align.fill_missing(df, Spec().schema)
    assert filled.columns == [name for name, _ in CANONICAL_COLUMNS] + ["novidade"]
    types = dict(filled.dtypes)
    assert (types[R.tax_value], types[R.year], types[R.registered]) == ("double", "int", "date")
    assert filled.select(R.tax_value, "bairro", "novidade").first() == (None, "A", "x")


def raw_year(spark, **overrides):
    cells = {
        "Número do contribuinte": "77", R.year: "2020", R.registered: "2020/1/5 00:00:00.000000000",
        "bairro": " BOA VIAGEM ", "numero": "S/N", R.built_year: "1985", R.tax_value: "R$ 1234,56",
        R.postal_code: "5000", R.land_area: "12,5",
    }
    cells.update(overrides)
    return spark.createDataFrame([tuple(cells.values())], list(cells))


def test_align_year_types_and_trims(spark):
    aligned = align.align_year(raw_year(spark), 2020)
    got = aligned.select(
        R.entity, R.year, R.registered, "bairro", "numero", R.built_year, R.tax_value,
        R.postal_code, R.land_area,
    ).first()
    assert tuple(got) == (
        "77", 2020, dt.date(2020, 1, 5), "BOA VIAGEM", None, 1985, 1234.56, "00005000", 12.5,
    )
    assert aligned.schema.fieldNames()[:32] == Spec().columns
    again = align.align_year(aligned, 2020)
    assert again.schema == aligned.schema and rows(again) == rows(aligned)


def test_union_of_aligned_years_neither_widens_nor_fails(spark):
    text = align.align_year(raw_year(spark, **{R.tax_value: "não informado"}), 2020)
    numeric = align.align_year(
        spark.createDataFrame([("88", 2021, 9.5, 1)], [R.entity, R.year, R.tax_value, "_id"]), 2021
    )
    union = align.union_years([text, numeric])
    assert dict(union.dtypes)[R.tax_value] == "double"
    assert rows(union, R.entity, R.tax_value, "_id") == [("77", None, None), ("88", 9.5, "1")]


def test_union_conserves_rows(spark):
    frames = [spark.range(n).withColumnRenamed("id", f"c{n}") for n in (3, 5, 7)]
    assert align.union_years(frames).count() == 15


def test_guards(spark):
    twice = spark.createDataFrame([(1, 2)], ["a", "b"]).toDF("a", "a")
    with pytest.raises(SchemaError):
        align.align_year(twice, 2020)
    with pytest.raises(SchemaError):
        align.require_columns(spark.range(1), ["x"])
    with pytest.raises(SchemaError):
        align.union_years([])


def test_append_years_skips_stored_years(spark):
    stored = spark.createDataFrame([(2020, "a"), (2021, "b")], "ano int, v string")
    incoming = spark.createDataFrame(
        [(2021, "again"), (2022, "c"), (None, "n")], "ano int, v string"
    )
    got = rows(align.append_years(stored, incoming, "ano"))
    assert got == [(2020, "a"), (2021, "b"), (2022, "c"), (None, "n")]
    nothing = stored.limit(0)
    assert align.append_years(nothing, incoming, "ano").count() == 3


def edit_distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            previous, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, previous + (x != y))
    return line[-1]


def test_canonicalize_values_against_brute_force(spark):
    values = ["boa viagen", "BOA VIAGEM", "casa forte", "cassa forti", "zzz", "", " ibura ", None]
    reference = ["Boa Viagem", "Casa Forte", "Ibura"]
    df = spark.createDataFrame([(v,) for v in values for _ in range(2)], "b string")
    got = {r["value"]: (r["rows"], r["canonical"]) for r in
           align.canonicalize_values(df, "b", reference).collect()}
    for value in values:
        if value is None:
            assert got[None] == (2, None)
            continue
        plain = value.strip().lower()
        scores = [
            1 - edit_distance(plain, r.lower()) / max(len(plain), len(r)) for r in reference
        ]
        best = max(scores)
        expected = reference[scores.index(best)] if best >= 0.7 else None
        assert got[value] == (2, expected)
    with pytest.raises(SchemaError):
        align.canonicalize_values(df, "b", reference, threshold=0.4)
    many = [f"rua {n:04d}" for n in range(900)] + reference
    assert {r["value"]: r["canonical"] for r in align.canonicalize_values(df, "b", many).collect()}["boa viagen"] == "Boa Viagem"
    replaced = align.canonicalize_column(df, "b", reference)
    assert replaced.count() == df.count() and replaced.where("b = 'Boa Viagem'").count() == 4


def test_values_stay_where_they_were_counted(spark):
    """Only the reference is broadcast: the values, which grow, are shuffled once."""
    df = spark.range(3000).selectExpr("concat('rua ', cast(id % 700 as string)) AS b")
    found = align.canonicalize_values(df, "b", ["Rua 10", "Rua 11", "Casa Forte"])
    assert {r["value"]: r["canonical"] for r in found.collect()}["rua 110"] == "Rua 10"
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("Initial Plan")[-1].splitlines() if "Exchange" in line]
    assert sum("hashpartitioning(b#" in line for line in exchanges) == 1
    assert all("hashpartitioning(b#" in line or "BroadcastExchange" in line for line in exchanges)


def test_matches_do_not_depend_on_the_order_of_columns():
    sources, targets = ["bairos", "bairo", "cidad"], ["bairro", "cidade", "cidades"]
    first = align.match_similar_names(sources, targets)
    assert first == align.match_similar_names(sources[::-1], targets[::-1])
    # the best pair is handed out first, whichever column comes first
    assert first["bairo"][0] == "bairro" and first["cidad"][0] == "cidade" and "bairos" not in first


def test_extra_columns_become_text(spark):
    df = spark.createDataFrame([("A", 3)], ["bairro", "foo"])
    assert dict(align.align_year(df, 2022).dtypes)["foo"] == "string"
