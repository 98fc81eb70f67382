"""State queries: U1-U6 and U8 over the month-pair fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import CURR_MONTH, DETECTED_AT, PREV_MONTH, Fixtures, duckdb_with
from ..operators.state import (
    append_multiset,
    apply_changes,
    change_log,
    classify_counts,
    diff,
    insert_ignore,
    latest_by_key,
)
from ..oracle_sql import FX_COLUMNS, d_conform
from ..plans.store import Store
from ..plans.upsert import upsert_tables
from ..schema import TABLES, TEXT, conform
from ..session import scratch_path
from .base import register

TRACKED = ["empresa", "estabelecimento", "simples"]
EMP_COLS = TABLES["empresa"].column_names


def _pair(fx: Fixtures, table: str):
    spec = TABLES[table]
    return conform(fx[f"fx_{table}_prev"], spec), conform(fx[f"fx_{table}_curr"], spec)


# Snapshot with duplicates: the month file plus a second file that
# repeats every key % 25 = 0 under another name; the first file must win.
DUP_SQL = """
SELECT *, 'Empresas0.csv' AS _file, CAST(cnpj_basico AS BIGINT) AS _ord FROM {fx_empresa_curr}
UNION ALL
SELECT cnpj_basico, concat(razao_social, ' (2)') AS razao_social, natureza_juridica, qualificacao_responsavel,
  capital_social, porte_empresa, ente_federativo_responsavel, 'Empresas1.csv' AS _file,
  CAST(cnpj_basico AS BIGINT) AS _ord
FROM {fx_empresa_curr} WHERE CAST(cnpj_basico AS BIGINT) % 25 = 0"""

_EMP = ", ".join(EMP_COLS)


@register(
    "u1_insert_ignore",
    duckdb_with("fx_empresa_prev", "fx_empresa_curr").rstrip()
    + ", inc AS ("
    + DUP_SQL.replace("{fx_empresa_curr}", "fx_empresa_curr")
    + f"""), dedup AS (
  SELECT {_EMP} FROM (SELECT *, row_number() OVER (PARTITION BY cnpj_basico ORDER BY _file, _ord) AS rn FROM inc)
  WHERE rn = 1)
SELECT {_EMP} FROM fx_empresa_prev
UNION ALL
SELECT {_EMP} FROM dedup d WHERE NOT EXISTS (SELECT 1 FROM fx_empresa_prev p WHERE p.cnpj_basico = d.cnpj_basico)""",
)
def u1_insert_ignore(fx: Fixtures):
    """Stored rows win, first duplicate of the input wins."""
    inc = fx.sql(DUP_SQL)
    return insert_ignore(fx["fx_empresa_prev"], inc, ["cnpj_basico"], ["_file", "_ord"])


@register(
    "u2_latest_by_key",
    duckdb_with("fx_empresa_prev", "fx_empresa_curr")
    + f"""
SELECT {_EMP} FROM (
  SELECT *, row_number() OVER (PARTITION BY cnpj_basico ORDER BY seq DESC) AS rn FROM (
    SELECT *, 1 AS seq FROM fx_empresa_prev UNION ALL SELECT *, 2 AS seq FROM fx_empresa_curr))
WHERE rn = 1""",
)
def u2_latest_by_key(fx: Fixtures):
    """Last inserted row per key wins (replacing-merge semantics)."""
    both = fx["fx_empresa_prev"].withColumn("seq", F.lit(1)).unionByName(
        fx["fx_empresa_curr"].withColumn("seq", F.lit(2))
    )
    return latest_by_key(both, ["cnpj_basico"], ["seq"])


@register(
    "u3_append_multiset",
    duckdb_with("fx_socios") + "SELECT * FROM fx_socios UNION ALL SELECT * FROM fx_socios",
)
def u3_append_multiset(fx: Fixtures):
    """Keyless partners appended twice; duplicates are kept."""
    return append_multiset(fx["fx_socios"], fx["fx_socios"])


# ---- DuckDB spelling of the comparison ---------------------------------------------------------


def _conformed_pair_ctes(table: str) -> str:
    have = FX_COLUMNS[table]
    return (
        f", o_{table} AS ({d_conform(f'fx_{table}_prev', table, have)})"
        f", n_{table} AS ({d_conform(f'fx_{table}_curr', table, have)})"
    )


def _d_join_on(table: str) -> str:
    return " AND ".join(f"o.{k} = n.{k}" for k in TABLES[table].keys)


def _d_same(table: str, c: str) -> str:
    if TABLES[table].type_of(c) == TEXT:
        return f"coalesce(o.{c}, '') = coalesce(n.{c}, '')"
    return f"o.{c} IS NOT DISTINCT FROM n.{c}"


def _d_counts(table: str) -> str:
    spec = TABLES[table]
    other = [c for c in spec.column_names if c not in spec.keys]
    same = " AND ".join(_d_same(table, c) for c in other)
    k0 = spec.keys[0]
    incomplete = " OR ".join(f"{k} IS NULL" for k in spec.keys)
    return f"""
SELECT '{table}' AS tabela,
  (SELECT CAST(count(*) AS BIGINT) FROM n_{table}) AS incoming,
  CAST(count_if(o.{k0} IS NULL) AS BIGINT) AS new,
  CAST(count_if(o.{k0} IS NOT NULL AND n._p IS NOT NULL AND NOT ({same})) AS BIGINT) AS changed,
  CAST(count_if(o.{k0} IS NOT NULL AND n._p IS NOT NULL AND ({same})) AS BIGINT) AS unchanged,
  CAST(count_if(n._p IS NULL) AS BIGINT) AS kept_absent,
  (SELECT CAST(count(*) AS BIGINT) FROM n_{table} WHERE {incomplete}) AS rejected
FROM o_{table} o FULL OUTER JOIN (SELECT *, 1 AS _p FROM n_{table} WHERE NOT ({incomplete})) n
  ON {_d_join_on(table)}"""


def _pair_ctes() -> str:
    names = [f"fx_{t}_{s}" for t in TRACKED for s in ("prev", "curr")]
    return duckdb_with(*names).rstrip() + "".join(_conformed_pair_ctes(t) for t in TRACKED) + "\n"


@register("u4_classify", _pair_ctes() + "\nUNION ALL\n".join(_d_counts(t) for t in TRACKED))
def u4_classify(fx: Fixtures):
    """U4: new / changed / unchanged counts of each tracked table."""
    out = None
    for t in TRACKED:
        prev, curr = _pair(fx, t)
        c = classify_counts(diff(prev, curr, TABLES[t]), t)
        out = c if out is None else out.unionByName(c)
    return out


def _d_log(table: str) -> str:
    spec = TABLES[table]
    other = [c for c in spec.column_names if c not in spec.keys]
    parts = []
    for c in other:
        parts.append(
            f"""SELECT n.cnpj_basico, '{table}' AS tabela, '{c}' AS campo,
  coalesce(CAST(o.{c} AS VARCHAR), '') AS valor_antigo, coalesce(CAST(n.{c} AS VARCHAR), '') AS valor_novo,
  '{CURR_MONTH}' AS competencia, TIMESTAMP '{DETECTED_AT}' AS detectado_em
FROM o_{table} o JOIN n_{table} n ON {_d_join_on(table)}
WHERE coalesce(CAST(o.{c} AS VARCHAR), '') <> coalesce(CAST(n.{c} AS VARCHAR), '')"""
        )
    return "\nUNION ALL\n".join(parts)


@register("u5_change_log", _pair_ctes() + "\nUNION ALL\n".join(_d_log(t) for t in TRACKED))
def u5_change_log(fx: Fixtures):
    """Field-level change log of all three tracked tables."""
    out = None
    for t in TRACKED:
        prev, curr = _pair(fx, t)
        c = change_log(prev, curr, TABLES[t], CURR_MONTH, DETECTED_AT)
        out = c if out is None else out.unionByName(c)
    return out


ESTAB_KEYS = list(TABLES["estabelecimento"].keys)

U6_SQL = (
    _pair_ctes()
    + """
SELECT * FROM n_estabelecimento
UNION ALL
SELECT * FROM o_estabelecimento o WHERE NOT EXISTS (
  SELECT 1 FROM n_estabelecimento n WHERE """
    + _d_join_on("estabelecimento")
    + ")"
)


@register("u6_apply_changes", U6_SQL)
def u6_apply_changes(fx: Fixtures):
    """Branch state after the snapshot (absent rows kept)."""
    prev, curr = _pair(fx, "estabelecimento")
    return apply_changes(prev, curr, ESTAB_KEYS)


@register("u8_tracked_upsert", U6_SQL)
def u8_tracked_upsert(fx: Fixtures):
    """Load month n-1, tracked-upsert month n into a fresh store, read back."""
    store = Store(fx.spark, scratch_path(fx.spark, "u8-store"))
    for i, month in enumerate((PREV_MONTH, CURR_MONTH)):
        tx = store.begin(month)
        upsert_tables(tx, {t: _pair(fx, t)[i] for t in TRACKED}, month, DETECTED_AT, order=None)
        tx.commit()
    return store.read("estabelecimento")
