"""The canonical record: column names, types, aliases, thresholds and roles."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "date": DateType(),
}

# Canonical columns in file order, each with the type it is stored as.
CANONICAL_COLUMNS = (
    ("Número do contribuinte", "string"),
    ("ano do exercício", "int"),
    ("data do cadastramento", "date"),
    ("tipo de contribuinte", "string"),
    ("CPF/CNPJ mascarado do contribuinte", "string"),
    ("logradouro", "string"),
    ("numero", "double"),
    ("complemento", "string"),
    ("bairro", "string"),
    ("cidade", "string"),
    ("estado", "string"),
    ("fração ideal", "double"),
    ("AREA TERRENO", "double"),
    ("AREA CONSTRUIDA", "double"),
    ("área ocupada", "double"),
    ("valor do m2 do terreno", "double"),
    ("valor do m2 de construção", "double"),
    ("ano da construção corrigido", "int"),
    ("quant pavimentos", "double"),
    ("tipo de uso do imóvel", "string"),
    ("tipo de padrão da construção", "string"),
    ("fator de obsolescência", "double"),
    ("ano e mês de início da contribuição", "double"),
    ("valor total do imóvel estimado", "double"),
    ("valor IPTU", "double"),
    ("CEP", "string"),
    ("Regime de Tributação do iptu", "string"),
    ("Regime de Tributação da trsd", "string"),
    ("Tipo de Construção", "string"),
    ("Tipo de Empreendimento", "string"),
    ("Tipo de Estrutura", "string"),
    ("Código Logradouro", "double"),
)

# Column renames that apply to one fiscal year's file.
RENAMES_BY_YEAR = {2024: {"quantidade de pavimentos": "quant pavimentos"}}

# Other spellings of canonical columns, accepted in any year.
KNOWN_ALIASES = {
    "quantidade de pavimentos": "quant pavimentos",
    "valor cobrado de IPTU": "valor IPTU",
}

# Columns a given year may carry beyond the canonical ones.
EXPECTED_EXTRAS_BY_YEAR = {2024: ("_id",)}

# Upper age limits in years (None = open) and their labels.
AGE_BANDS_7 = (
    (10, "0-10 anos"),
    (20, "11-20 anos"),
    (30, "21-30 anos"),
    (40, "31-40 anos"),
    (50, "41-50 anos"),
    (60, "51-60 anos"),
    (None, "60+ anos"),
)
AGE_BANDS_6 = (
    (10, "0-10"),
    (20, "11-20"),
    (30, "21-30"),
    (40, "31-40"),
    (50, "41-50"),
    (None, "50+"),
)

# Layouts of the registration date; the fraction is optional.
REGISTRATION_DATE_FORMAT = "yyyy/M/d HH:mm:ss[.SSSSSSSSS]"

# The audit columns each layer adds.
YEAR_PARTITION = "_year_partition"
INTERNAL_PREFIX = "_"
KEPT_INTERNAL_COLUMNS = ("_id",)


def canonical_schema() -> StructType:
    return StructType(
        [StructField(name, _TYPES[type_]) for name, type_ in CANONICAL_COLUMNS]
    )


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; operators never name a column directly."""

    entity: str = "Número do contribuinte"
    year: str = "ano do exercício"
    registered: str = "data do cadastramento"
    neighborhood: str = "bairro"
    city: str = "cidade"
    state: str = "estado"
    land_area: str = "AREA TERRENO"
    built_area: str = "AREA CONSTRUIDA"
    built_year: str = "ano da construção corrigido"
    use_type: str = "tipo de uso do imóvel"
    property_value: str = "valor total do imóvel estimado"
    tax_value: str = "valor IPTU"
    postal_code: str = "CEP"
    construction_type: str = "Tipo de Construção"


@dataclass(frozen=True)
class Thresholds:
    min_rows_per_year: int = 100
    max_null_pct: float = 50.0
    max_gold_null_pct: float = 20.0
    low_cardinality: int = 50
    min_support: int = 10


@dataclass(frozen=True)
class Domain:
    """Allowed values of one column, compared after trimming and upper-casing."""

    column: str
    allowed: tuple[str, ...]


@dataclass(frozen=True)
class Spec:
    """Everything the operators need to know about one kind of record."""

    schema: StructType = field(default_factory=canonical_schema)
    roles: Roles = Roles()
    thresholds: Thresholds = Thresholds()
    domains: tuple[Domain, ...] = (Domain("cidade", ("RECIFE",)), Domain("estado", ("PE",)))
    aliases: dict[str, str] = field(default_factory=lambda: dict(KNOWN_ALIASES))
    renames_by_year: dict[int, dict[str, str]] = field(
        default_factory=lambda: {year: dict(names) for year, names in RENAMES_BY_YEAR.items()}
    )

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


ROLES = Roles()
