"""Sink and layout queries: K2 layout, K5 index export, K6 bulk TSV export."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import CURR_MONTH, Fixtures, duckdb_with
from ..operators.reads import search_documents
from ..oracle_sql import FX_COLUMNS, d_bulk
from ..plans.colocated import colocated_profiles, colocated_view, write_colocated
from ..plans.places import branches_in, search_place, write_places
from ..plans.sinks import export_index, export_tsv, layout
from ..plans.store import Store
from ..schema import NUMERIC, TABLES, conform
from ..session import scratch_path
from ..sources.csv import to_registry_text
from .base import ORACLES, register
from .reads import REQUESTS_SQL
from .search import CONTAINS_Q, CONTAINS_UF, DOC_COLS, DOCS_SQL, LIMIT, REG
from .state import U6_SQL, _pair

KEYS3 = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]


def _lengths(t: str, have: list[str], cast: str) -> str:
    """Characters of all typed values of a table."""
    return " + ".join(f"coalesce(length(CAST({c} AS {cast})), 0)" for c in TABLES[t].column_names if c in have)


_K1_VIEWS = {
    "empresa": "fx_empresa", "estabelecimento": "fx_estabelecimento", "simples": "fx_simples", "socios": "fx_socios", "cnae": "fx_cnae",
    "municipio": "fx_municipio", "motivo_situacao_cadastral": "fx_motivo", "natureza_juridica": "fx_natureza", "pais": "fx_natureza",
    "qualificacao_socio": "fx_cnae",
}


def _k1_have(t: str) -> list[str]:
    return FX_COLUMNS.get(t, ["codigo", "descricao"])


@register(
    "k1_write_tables",
    duckdb_with(*sorted(set(_K1_VIEWS.values())))
    + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tabela, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT {TABLES[t].column_names[0]}) AS BIGINT) AS keys, "
        f"CAST(sum({_lengths(t, _k1_have(t), 'VARCHAR')}) AS BIGINT) AS characters FROM {v}"
        for t, v in _K1_VIEWS.items()
    ),
)
def k1_write_tables(fx: Fixtures):
    """K1: all ten typed tables published in one commit and read back: rows,
    different first keys, and the characters of all their values."""
    store = Store(fx.spark, scratch_path(fx.spark, "k1"))
    tx = store.begin(CURR_MONTH)
    for t, v in _K1_VIEWS.items():
        tx.write_table(t, conform(fx[v], TABLES[t]), sort_by=[TABLES[t].column_names[0]])
    tx.commit()
    commits, out = store.commits(), None
    for t in _K1_VIEWS:
        df = store.read(t, TABLES[t].struct, commits)
        n = df.agg(
            F.lit(t).alias("tabela"), F.count("*").alias("rows"), F.count_distinct(TABLES[t].column_names[0]).alias("keys"),
            F.sum(F.expr(_lengths(t, TABLES[t].column_names, "STRING"))).cast("bigint").alias("characters"))
        out = n if out is None else out.unionByName(n)
    return out


@register("k2_layout", U6_SQL.split("\nSELECT * FROM n_estabelecimento")[0] + "\nSELECT * FROM o_estabelecimento")
def k2_layout(fx: Fixtures):
    """K2: stored branches re-laid out by key range with bloom filters, read back."""
    prev, _ = _pair(fx, "estabelecimento")
    path = scratch_path(fx.spark, "k2") + "/estabelecimento"
    layout(prev, path, KEYS3, bloom=["cnae_fiscal_principal", "municipio"])
    return fx.spark.read.parquet(path)


@register("k2_colocated_view", ORACLES["j1_registry_view"])
def k2_colocated_view(fx: Fixtures):
    """K2: J1 over bucketed tables of the company key, without an exchange of them."""
    t = fx.registry()
    return colocated_view(write_colocated(t, scratch_path(fx.spark, "k2-colocated")), t)


@register("k2_colocated_profiles", ORACLES["j2_profiles"])
def k2_colocated_profiles(fx: Fixtures):
    """K2: J2 over bucketed tables; only the requests move."""
    return colocated_profiles(write_colocated(fx.registry(), scratch_path(fx.spark, "k2-colocated")), fx.sql(REQUESTS_SQL))


@register("k2_place_search", ORACLES["q7_search_contains"])
def k2_place_search(fx: Fixtures):
    """K2: Q7 in one uf over the copy by place, which reads that uf's folder only."""
    return search_place(write_places(fx.registry(), scratch_path(fx.spark, "k2-places") + "/branches"), CONTAINS_Q, CONTAINS_UF, LIMIT)


@register(
    "k2_place_counts",
    duckdb_with("fx_estabelecimento")
    + """
SELECT uf, municipio, CAST(count(*) AS BIGINT) AS branches, CAST(count(*) FILTER (WHERE situacao_cadastral = 2) AS BIGINT) AS active
FROM fx_estabelecimento WHERE uf IN (SELECT substr(upper(r_name), 1, 2) FROM region WHERE r_name LIKE 'A%') GROUP BY uf, municipio""",
)
def k2_place_counts(fx: Fixtures):
    """K2: branches by municipality of some regions' places; folders are pruned at run time."""
    placed = write_places(fx.registry(), scratch_path(fx.spark, "k2-places") + "/branches")
    return branches_in(placed, fx.sql("SELECT substr(upper(r_name), 1, 2) AS uf FROM {region} WHERE r_name LIKE 'A%'"))


@register("k5_index_export", REG.rstrip() + DOCS_SQL + f"SELECT {DOC_COLS} FROM docs")
def k5_index_export(fx: Fixtures):
    """K5: search documents exported as JSON lines, read back."""
    path = scratch_path(fx.spark, "k5")
    export_index(search_documents(fx.registry(), ordered=False), path)
    docs = fx.spark.read.schema("cnpj string, razao_social string, nome_fantasia string, uf string, cnae bigint")
    return docs.json(f"{path}/documents")


def _d_registry_text(c: str, kind: str) -> str:
    v = f"CAST({c} AS VARCHAR)"
    return f"replace({v}, '.', ',')" if kind == NUMERIC else v


@register(
    "k6_bulk_tsv_export",
    duckdb_with("fx_empresa")
    + "SELECT "
    + " || chr(9) || ".join(d_bulk(_d_registry_text(c, k), k) for c, k in TABLES["empresa"].columns)
    + " AS value FROM fx_empresa",
)
def k6_bulk_tsv_export(fx: Fixtures):
    """K6: companies as bulk-load text (F11 on every field), read back line by line."""
    spec = TABLES["empresa"]
    path = scratch_path(fx.spark, "k6")
    export_tsv(to_registry_text(fx["fx_empresa"], spec), spec, path)
    return fx.spark.read.option("lineSep", "\n").text(path)
