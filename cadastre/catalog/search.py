"""Statistics, history, documents and search queries: Q1-Q10, K3, K4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import BASE_TABLES, CURR_MONTH, DETECTED_AT, PREV_MONTH, Fixtures, duckdb_with
from ..operators.ledger import latest_processed
from ..operators.reads import (
    SKETCH_ERROR,
    change_history,
    page,
    rows_in_footers,
    search_documents,
    stats_exact,
    stats_final,
    stats_from_commits,
    stats_from_sketches,
)
from ..operators.search import search, search_contains, search_fuzzy, search_prefix
from ..operators.state import change_log
from ..plans.indexes import build_index, indexed_contains, indexed_fuzzy, indexed_prefix
from ..plans.store import Store
from ..plans.upsert import read_sketches, upsert_tables
from ..schema import TABLES, conform
from ..session import scratch_path
from .base import register
from .state import TRACKED, _d_log, _pair, _pair_ctes

# Fixed search parameters of the checks (FIXTURES.md "Other parameters").
CONTAINS_Q, CONTAINS_UF = "ring", "am"
PREFIX_Q = "blue wid"
SHORT_Q = "an"
FUZZY_Q = "widgte"
LIMIT = 100

REG = duckdb_with("fx_estabelecimento", "fx_empresa", "fx_simples", "fx_socios", "fx_ledger")

DOCS_SQL = """, docs AS (
  SELECT e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv AS cnpj, coalesce(emp.razao_social, '') AS razao_social,
    coalesce(e.nome_fantasia, '') AS nome_fantasia, coalesce(e.uf, '') AS uf,
    coalesce(e.cnae_fiscal_principal, 0) AS cnae,
    emp.razao_social AS _razao, e.nome_fantasia AS _fantasia, e.uf AS _uf
  FROM fx_estabelecimento e LEFT JOIN fx_empresa emp ON e.cnpj_basico = emp.cnpj_basico)
"""
DOC_COLS = "cnpj, razao_social, nome_fantasia, uf, cnae"


def _tables(fx: Fixtures) -> dict:
    t = fx.registry()
    t["socios"] = conform(fx["fx_socios"], TABLES["socios"])
    return t


# ---- Q1-Q3 -----------------------------------------------------------------------------------


@register(
    "q1_stats",
    REG
    + """
SELECT (SELECT count(*) FROM fx_empresa) AS empresas, (SELECT count(*) FROM fx_estabelecimento) AS estabelecimentos,
  (SELECT count(*) FROM fx_socios) AS socios,
  (SELECT arg_max(data_month, data_month || '|' || filename) FROM fx_ledger WHERE status = 'SUCCESS') AS latest_month""",
)
def q1_stats(fx: Fixtures):
    """Q1: exact counts plus the latest processed month."""
    lm = latest_processed(fx["fx_ledger"].where(F.col("status") == "SUCCESS"), ["data_month", "filename"])
    return stats_exact(_tables(fx), lm)


@register(
    "q2_stats_estimate",
    REG
    + """
SELECT (SELECT count(*) FROM fx_empresa) AS empresas, (SELECT count(*) FROM fx_estabelecimento) AS estabelecimentos,
  (SELECT count(*) FROM fx_socios) AS socios""",
)
def q2_stats_estimate(fx: Fixtures):
    """Q2: publish the tables, then answer from stored row counts (metadata only)."""
    store = Store(fx.spark, scratch_path(fx.spark, "q2-store"))
    tx = store.begin("2026-09")
    t = _tables(fx)
    for name in ("empresa", "estabelecimento", "socios"):
        tx.write_table(name, t[name])
    tx.commit()
    n = stats_from_commits(store.commits())
    return fx.spark.createDataFrame(
        [(n["empresa"], n["estabelecimento"], n["socios"])], "empresas bigint, estabelecimentos bigint, socios bigint")


@register(
    "q3_stats_final",
    duckdb_with("fx_empresa_prev", "fx_empresa_curr", "fx_estabelecimento_prev", "fx_estabelecimento_curr", "fx_socios")
    + """
SELECT (SELECT count(*) FROM (SELECT cnpj_basico FROM fx_empresa_prev UNION SELECT cnpj_basico FROM fx_empresa_curr)) AS empresas,
  (SELECT count(*) FROM (SELECT cnpj_basico, cnpj_ordem, cnpj_dv FROM fx_estabelecimento_prev
                         UNION SELECT cnpj_basico, cnpj_ordem, cnpj_dv FROM fx_estabelecimento_curr)) AS estabelecimentos,
  (SELECT count(*) FROM fx_socios) AS socios""",
)
def q3_stats_final(fx: Fixtures):
    """Q3: counts of a replacing-merge table holding two loads (distinct keys)."""
    t = {
        "empresa": fx["fx_empresa_prev"].unionByName(fx["fx_empresa_curr"]),
        "estabelecimento": fx["fx_estabelecimento_prev"].unionByName(fx["fx_estabelecimento_curr"]),
        "socios": fx["fx_socios"],
    }
    return stats_final(t)


@register("q2_footer_estimate", "\nUNION ALL ".join(
    f"SELECT '{t}' AS tabela, CAST(count(*) AS BIGINT) AS rows FROM {t}" for t in BASE_TABLES) + "\nUNION ALL SELECT 'not there', CAST(0 AS BIGINT)")
def q2_footer_estimate(fx: Fixtures):
    """Q2: rows of every given table from the footers of its files; no column is read."""
    files = {t: f"{fx.sf_dir}/{t}.parquet" for t in BASE_TABLES} | {"not there": f"{fx.sf_dir}/not_there.parquet"}
    return rows_in_footers(fx.spark, files).select("tabela", "rows")


@register(
    "q3_stats_sketch",
    duckdb_with("fx_empresa_prev", "fx_empresa_curr", "fx_estabelecimento_prev", "fx_estabelecimento_curr")
    + """
SELECT 'empresa' AS tabela, CAST(count(*) AS BIGINT) AS exact, true AS within_bound
FROM (SELECT cnpj_basico FROM fx_empresa_prev UNION SELECT cnpj_basico FROM fx_empresa_curr)
UNION ALL SELECT 'estabelecimento', CAST(count(*) AS BIGINT), true
FROM (SELECT cnpj_basico, cnpj_ordem, cnpj_dv FROM fx_estabelecimento_prev UNION SELECT cnpj_basico, cnpj_ordem, cnpj_dv FROM fx_estabelecimento_curr)""",
)
def q3_stats_sketch(fx: Fixtures):
    """Q3 (approximate): distinct keys of two loads from the sketches stored with each,
    against the exact counts, and whether the error is within its bound."""
    store = Store(fx.spark, scratch_path(fx.spark, "q3-sketches"))
    for suffix, month in (("_prev", PREV_MONTH), ("_curr", CURR_MONTH)):
        tx, t = store.begin(month), fx.registry(suffix)
        upsert_tables(tx, {n: t[n] for n in ("empresa", "estabelecimento")}, month, DETECTED_AT, order=None)
        tx.commit()
    exact = None
    for t in ("empresa", "estabelecimento"):
        one = store.read(t, TABLES[t].struct).select(*TABLES[t].keys).distinct().agg(F.lit(t).alias("tabela"), F.count("*").alias("exact"))
        exact = one if exact is None else exact.unionByName(one)
    near = F.abs(F.col("estimate") - F.col("exact")) <= SKETCH_ERROR * F.col("exact")
    return exact.join(stats_from_sketches(read_sketches(store)), "tabela").select("tabela", "exact", near.alias("within_bound"))


# ---- Q4 --------------------------------------------------------------------------------------

Q4_SQL = (
    _pair_ctes().rstrip()
    + ", log AS ("
    + "\nUNION ALL\n".join(_d_log(t) for t in TRACKED)
    + """), wanted AS (
  SELECT DISTINCT substr(regexp_replace(substr(cnpj_basico,1,2) || '.' || substr(cnpj_basico,3,3) || '.' || substr(cnpj_basico,6,3) || '/0001-00', '[^a-zA-Z0-9]', '', 'g'), 1, 8) AS cnpj_basico
  FROM fx_empresa)
SELECT l.*, CAST(count(*) OVER (PARTITION BY l.cnpj_basico) AS BIGINT) AS total_count
FROM log l WHERE l.cnpj_basico IN (SELECT cnpj_basico FROM wanted)"""
)

REQUESTS_SQL = """
SELECT concat(substr(cnpj_basico,1,2), '.', substr(cnpj_basico,3,3), '.', substr(cnpj_basico,6,3), '/0001-00') AS requested
FROM {fx_empresa}"""


@register("q4_change_history", Q4_SQL)
def q4_change_history(fx: Fixtures):
    """Q4 (bulk): history of every company requested by its masked key, with counts."""
    log = None
    for t in TRACKED:
        prev, curr = _pair(fx, t)
        c = change_log(prev, curr, TABLES[t], CURR_MONTH, DETECTED_AT)
        log = c if log is None else log.unionByName(c)
    return change_history(log, fx.sql(REQUESTS_SQL))


# ---- Q5, Q6 ----------------------------------------------------------------------------------


@register("q5_search_documents", REG.rstrip() + DOCS_SQL + f"SELECT {DOC_COLS} FROM docs")
def q5_search_documents(fx: Fixtures):
    """Q5: search documents of every branch, ordered by key."""
    return search_documents(fx.registry())


@register(
    "q6_page",
    REG.rstrip()
    + DOCS_SQL
    + f""", p AS (SELECT {DOC_COLS} FROM docs ORDER BY cnpj LIMIT 21 OFFSET 40)
SELECT {DOC_COLS}, (SELECT count(*) FROM p) > 20 AS has_more
FROM (SELECT *, row_number() OVER (ORDER BY cnpj) AS rn FROM p) WHERE rn <= 20""",
)
def q6_page(fx: Fixtures):
    """Q6: page offset 40, limit 20 of the documents, with has_more."""
    return page(search_documents(fx.registry(), ordered=False), ["cnpj"], 40, 20)


# ---- Q7-Q10, K3, K4 --------------------------------------------------------------------------


def _d_contains(q: str, uf: str | None, limit: int, extra: str = "") -> str:
    pat = "%" + q.lower() + "%"
    cond = f"(lower(_razao) LIKE '{pat}' OR lower(_fantasia) LIKE '{pat}')"
    if uf:
        cond += f" AND _uf = '{uf.upper()}'"
    return REG.rstrip() + DOCS_SQL + f"SELECT {DOC_COLS}{extra} FROM docs WHERE {cond} ORDER BY cnpj LIMIT {limit}"


def _d_tokens(c: str) -> str:
    return f"list_filter(string_split_regex(lower({c}), '[^\\p{{L}}\\p{{N}}_]+'), lambda k: k <> '')"


def _d_prefix(q: str, limit: int, extra: str = "") -> str:
    terms = [t.lower() for t in q.split()]

    def cond(c):
        return " AND ".join(f"len(list_filter({_d_tokens(c)}, lambda k: starts_with(k, '{t}'))) > 0" for t in terms)

    return (
        REG.rstrip()
        + DOCS_SQL
        + f"SELECT {DOC_COLS}{extra} FROM docs WHERE ({cond('_fantasia')}) OR (_razao IS NOT NULL AND {cond('_razao')}) "
        + f"ORDER BY cnpj LIMIT {limit}"
    )


@register("q7_search_contains", _d_contains(CONTAINS_Q, CONTAINS_UF, LIMIT))
def q7_search_contains(fx: Fixtures):
    """Q7: contains search 'ring' in uf AM (given lower-case), limit 100."""
    return search_contains(fx.registry(), CONTAINS_Q, CONTAINS_UF, LIMIT)


@register("q8_search_prefix", _d_prefix(PREFIX_Q, LIMIT))
def q8_search_prefix(fx: Fixtures):
    """Q8: prefix search 'blue wid', limit 100."""
    return search_prefix(fx.registry(), PREFIX_Q, None, LIMIT)


@register("q9_search", _d_contains(SHORT_Q, None, LIMIT, ", 'contains' AS source"))
def q9_search(fx: Fixtures):
    """Q9: cascade for a 2-character term: prefix rejects, contains answers."""
    return search(fx.registry(), SHORT_Q, None, LIMIT)


def _d_fuzzy(q: str, limit: int) -> str:
    words = q.lower().split()

    def dist(c, w):
        lev = f"levenshtein(x, '{w}')"
        edits = f"CASE WHEN length('{w}') < 5 THEN 0 WHEN length('{w}') < 9 THEN 1 ELSE 2 END"
        swapped = f"length('{w}') BETWEEN 5 AND 8 AND {lev} = 2 AND list_sort(string_split(x, '')) = list_sort(string_split('{w}', ''))"
        ok = f"({lev} <= {edits} OR ({swapped}))"
        return f"list_min(list_transform({_d_tokens(c)}, lambda x: CASE WHEN {ok} THEN {lev} END))"

    def score(c):
        ds = [dist(c, w) for w in words]
        total = "0.0"
        for d in ds:
            total = f"({total} + 1.0 / (1.0 + {d}))"
        exact = " AND ".join(f"{d} = 0" for d in ds)
        allm = " AND ".join(f"{d} IS NOT NULL" for d in ds)
        return f"CASE WHEN {allm} THEN {total} + CASE WHEN {exact} THEN 0.5 ELSE 0.0 END END"

    return (
        REG.rstrip()
        + DOCS_SQL
        + f""", scored AS (SELECT *, {score('_fantasia')} AS s1, {score('_razao')} AS s2 FROM docs)
SELECT {DOC_COLS}, CASE WHEN s1 IS NULL THEN s2 WHEN s2 IS NULL THEN s1 ELSE greatest(s1, s2) END AS score
FROM scored WHERE s1 IS NOT NULL OR s2 IS NOT NULL ORDER BY score DESC, cnpj LIMIT {limit}"""
    )


@register("q10_search_fuzzy", _d_fuzzy(FUZZY_Q, LIMIT))
def q10_search_fuzzy(fx: Fixtures):
    """Q10: typo-tolerant search 'widgte' (a transposition of 'widget'), limit 100."""
    return search_fuzzy(fx.registry(), FUZZY_Q, None, LIMIT)


def _index(fx: Fixtures, tables: dict):
    return build_index(fx.spark, tables, scratch_path(fx.spark, "search-index"))


@register("k3_indexed_contains", _d_contains(CONTAINS_Q, CONTAINS_UF, LIMIT))
def k3_indexed_contains(fx: Fixtures):
    """K3: build trigram postings, then answer Q7 through them."""
    t = fx.registry()
    return indexed_contains(t, _index(fx, t), CONTAINS_Q, CONTAINS_UF, LIMIT)


@register("k4_indexed_prefix", _d_prefix(PREFIX_Q, LIMIT))
def k4_indexed_prefix(fx: Fixtures):
    """K4: build token postings, then answer Q8 through them."""
    t = fx.registry()
    return indexed_prefix(t, _index(fx, t), PREFIX_Q, None, LIMIT)


@register("k4_indexed_fuzzy", _d_fuzzy(FUZZY_Q, LIMIT))
def k4_indexed_fuzzy(fx: Fixtures):
    """Q10 through K4: Levenshtein over the token vocabulary, then postings."""
    t = fx.registry()
    return indexed_fuzzy(t, _index(fx, t), FUZZY_Q, None, LIMIT)
