"""DuckDB SQL helpers for the correctness oracles.

The oracle of every registered query is plain DuckDB SQL over the driver's
parquet views; the registry-shaped fixtures are inlined as CTEs
(``fixtures.duckdb_with``).  These helpers spell the column rules of
``cadastre.functions`` once more in DuckDB's dialect.
"""

from __future__ import annotations

from .schema import INTEGER, NUMERIC, TABLES

# The typing rules spelled once more, apart from the operators that they check:
# what a Unicode trim removes, whole numbers, and decimals with an optional exponent.
SPACES = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WS = "'" + "".join(map(chr, SPACES)) + "'"
INTEGER_PATTERN = "^[-+]?\\d+$"
NUMBER_PATTERN = "^[-+]?(\\d+([.]\\d*)?|[.]\\d+)([eE][-+]?\\d+)?$"


def d_trim(x: str) -> str:
    return f"trim({x}, {WS})"


def d_text(x: str) -> str:
    return f"NULLIF({d_trim(x)}, '')"


def d_int(x: str) -> str:
    t = d_trim(x)
    return f"CASE WHEN regexp_matches({t}, '{INTEGER_PATTERN}') THEN TRY_CAST({t} AS BIGINT) END"


def d_num(x: str) -> str:
    t = f"replace({d_trim(x)}, ',', '.')"
    return f"CASE WHEN regexp_matches({t}, '{NUMBER_PATTERN}') THEN TRY_CAST({t} AS DECIMAL(15,2)) END"


def d_value(x: str, kind: str) -> str:
    return d_num(x) if kind == NUMERIC else d_int(x) if kind == INTEGER else d_text(x)


def d_canonical(x: str, kind: str) -> str:
    """S13 of an already typed column."""
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def d_escape(x: str) -> str:
    out = x
    for raw, esc in (("'\\'", "'\\\\'"), ("chr(9)", "'\\t'"), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'")):
        out = f"replace({out}, {raw}, {esc})"
    return out


def d_bulk(x: str, kind: str) -> str:
    t = d_trim(x)
    if kind == NUMERIC:
        n = f"replace({t}, ',', '.')"
        v = f"CASE WHEN regexp_matches({n}, '{NUMBER_PATTERN}') THEN {n} END"
    elif kind == INTEGER:
        v = f"CASE WHEN regexp_matches({t}, '{INTEGER_PATTERN}') AND TRY_CAST({t} AS BIGINT) IS NOT NULL THEN {t} END"
    else:
        v = f"NULLIF({t}, '')"
    return f"coalesce({d_escape(v)}, '\\N')"


_DUCK_TYPES = {"TEXT": "VARCHAR", "INTEGER": "BIGINT", "NUMERIC": "DECIMAL(15,2)"}


def d_conform(view: str, table: str, have: list[str]) -> str:
    """``SELECT`` of ``view`` with every declared column of ``table`` (missing → typed NULL)."""
    cols = []
    for c, k in TABLES[table].columns:
        cols.append(c if c in have else f"CAST(NULL AS {_DUCK_TYPES[k]}) AS {c}")
    return f"SELECT {', '.join(cols)} FROM {view}"


FX_COLUMNS = {
    "empresa": [c for c, _ in TABLES["empresa"].columns],
    "estabelecimento": [
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "nome_fantasia", "situacao_cadastral",
        "motivo_situacao_cadastral", "cnae_fiscal_principal", "tipo_logradouro", "logradouro", "numero",
        "complemento", "uf", "municipio", "ddd_1", "telefone_1",
    ],
    "simples": ["cnpj_basico", "opcao_pelo_simples", "opcao_mei"],
    "socios": ["cnpj_basico", "identificador_socio", "nome_socio_razao_social"],
}
