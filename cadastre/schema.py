"""Record layouts of the ten registry tables (data model, SURVEY §1).

The files carry no header, so every column is positional; the generic types
are TEXT, INTEGER and NUMERIC and map to string, bigint and decimal(15,2).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

TEXT = "TEXT"
INTEGER = "INTEGER"
NUMERIC = "NUMERIC"

DECIMAL = T.DecimalType(15, 2)

SPARK_TYPES = {TEXT: T.StringType(), INTEGER: T.LongType(), NUMERIC: DECIMAL}
SQL_TYPES = {TEXT: "STRING", INTEGER: "BIGINT", NUMERIC: "DECIMAL(15,2)"}


@dataclass(frozen=True)
class TableSpec:
    name: str
    markers: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...] = ()
    tracked: bool = False
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    def type_of(self, column: str) -> str:
        return dict(self.columns)[column]

    @property
    def struct(self) -> T.StructType:
        """Typed schema (after sanitising)."""
        return T.StructType([T.StructField(c, SPARK_TYPES[t], True) for c, t in self.columns])

    @property
    def raw_struct(self) -> T.StructType:
        """All-string schema used to read the positional text files."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c, _ in self.columns])

    @property
    def non_key_columns(self) -> list[str]:
        return [c for c in self.column_names if c not in self.keys]


# Table names, file-name markers (tested in this order, first
# substring match wins), positional columns with their generic types, primary
# keys and whether the table is change-tracked. They must equal the published
# record layouts for the files to load correctly.
CODE_COLUMNS = (
    ("codigo", INTEGER),
    ("descricao", TEXT),
)

TABLE_LIST = (
    TableSpec(
        "empresa",
        ("EMPRE",),
        (
            ("cnpj_basico", TEXT),
            ("razao_social", TEXT),
            ("natureza_juridica", INTEGER),
            ("qualificacao_responsavel", INTEGER),
            ("capital_social", NUMERIC),
            ("porte_empresa", INTEGER),
            ("ente_federativo_responsavel", TEXT),
        ),
        ("cnpj_basico",),
        True,
    ),
    TableSpec(
        "estabelecimento",
        ("ESTABELE", "ESTAB"),
        (
            ("cnpj_basico", TEXT),
            ("cnpj_ordem", TEXT),
            ("cnpj_dv", TEXT),
            ("identificador_matriz_filial", INTEGER),
            ("nome_fantasia", TEXT),
            ("situacao_cadastral", INTEGER),
            ("data_situacao_cadastral", INTEGER),
            ("motivo_situacao_cadastral", INTEGER),
            ("nome_cidade_exterior", TEXT),
            ("pais", TEXT),
            ("data_inicio_atividade", INTEGER),
            ("cnae_fiscal_principal", INTEGER),
            ("cnae_fiscal_secundaria", TEXT),
            ("tipo_logradouro", TEXT),
            ("logradouro", TEXT),
            ("numero", TEXT),
            ("complemento", TEXT),
            ("bairro", TEXT),
            ("cep", TEXT),
            ("uf", TEXT),
            ("municipio", INTEGER),
            ("ddd_1", TEXT),
            ("telefone_1", TEXT),
            ("ddd_2", TEXT),
            ("telefone_2", TEXT),
            ("ddd_fax", TEXT),
            ("fax", TEXT),
            ("correio_eletronico", TEXT),
            ("situacao_especial", TEXT),
            ("data_situacao_especial", INTEGER),
        ),
        ("cnpj_basico", "cnpj_ordem", "cnpj_dv"),
        True,
    ),
    TableSpec(
        "socios",
        ("SOCIO",),
        (
            ("cnpj_basico", TEXT),
            ("identificador_socio", INTEGER),
            ("nome_socio_razao_social", TEXT),
            ("cpf_cnpj_socio", TEXT),
            ("qualificacao_socio", INTEGER),
            ("data_entrada_sociedade", INTEGER),
            ("pais", INTEGER),
            ("representante_legal", TEXT),
            ("nome_do_representante", TEXT),
            ("qualificacao_representante_legal", INTEGER),
            ("faixa_etaria", INTEGER),
        ),
        (),
    ),
    TableSpec(
        "simples",
        ("SIMPLES", "SIMPLECS", "SIMPLE"),
        (
            ("cnpj_basico", TEXT),
            ("opcao_pelo_simples", TEXT),
            ("data_opcao_simples", INTEGER),
            ("data_exclusao_simples", INTEGER),
            ("opcao_mei", TEXT),
            ("data_opcao_mei", INTEGER),
            ("data_exclusao_mei", INTEGER),
        ),
        ("cnpj_basico",),
        True,
    ),
    TableSpec(
        "cnae",
        ("CNAE",),
        CODE_COLUMNS,
        ("codigo",),
    ),
    TableSpec(
        "motivo_situacao_cadastral",
        ("MOTI",),
        CODE_COLUMNS,
        ("codigo",),
    ),
    TableSpec(
        "municipio",
        ("MUNIC",),
        CODE_COLUMNS,
        ("codigo",),
    ),
    TableSpec(
        "natureza_juridica",
        ("NATJU",),
        CODE_COLUMNS,
        ("codigo",),
    ),
    TableSpec(
        "pais",
        ("PAIS",),
        CODE_COLUMNS,
        ("codigo",),
    ),
    TableSpec(
        "qualificacao_socio",
        ("QUALS", "QUAL"),
        CODE_COLUMNS,
        ("codigo",),
    ),
)

TABLES: dict[str, TableSpec] = {s.name: s for s in TABLE_LIST}

TRACKED = [n for n, s in TABLES.items() if s.tracked]
DOMAIN_TABLES = ["cnae", "motivo_situacao_cadastral", "municipio", "natureza_juridica", "pais", "qualificacao_socio"]

# Ledgers and the change log (SURVEY §1 "Other shapes").
FILE_LEDGER = T.StructType(
    [
        T.StructField("data_month", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)
MONTH_LEDGER = T.StructType(
    [
        T.StructField("data_month", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
        T.StructField("seq", T.LongType()),  # the version that recorded it
    ]
)
CHANGE_LOG = T.StructType(
    [
        T.StructField("cnpj_basico", T.StringType()),
        T.StructField("tabela", T.StringType()),
        T.StructField("campo", T.StringType()),
        T.StructField("valor_antigo", T.StringType()),
        T.StructField("valor_novo", T.StringType()),
        T.StructField("competencia", T.StringType()),
        T.StructField("detectado_em", T.TimestampNTZType()),
    ]
)
SEARCH_DOCUMENT_COLUMNS = ["cnpj", "razao_social", "nome_fantasia", "uf", "cnae"]


def conform(df, spec: TableSpec):
    """Select the declared columns in declared order; absent ones become typed NULLs."""
    from pyspark.sql import functions as F

    have = set(df.columns)
    return df.select(
        *[
            (F.col(c).cast(SPARK_TYPES[k]) if c in have else F.lit(None).cast(SPARK_TYPES[k])).alias(c)
            for c, k in spec.columns
        ]
    )
