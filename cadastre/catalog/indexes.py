"""Queries of postings that follow the data: outdated postings (K3/K4), search
right after a stream batch (T2), and searches without accents (B10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import CURR_MONTH, DETECTED_AT, PREV_MONTH, Fixtures, duckdb_with
from ..operators.search import search_contains
from ..plans.indexes import SearchIndex, build_index, committed_index, index_changes, indexed_contains, indexed_prefix
from ..plans.store import Store
from ..plans.upsert import upsert_tables
from ..schema import TABLES, conform
from ..session import scratch_path
from ..sources.csv import write_registry_csv
from ..streaming.ingest import ingest_stream, stream_upsert
from .base import register
from .search import DOC_COLS

NAMES = ("empresa", "estabelecimento")
LIMIT = 100


def _docs(company: str, branch: str = "fx_estabelecimento") -> str:
    """Documents of branches beside companies, in SQL."""
    return f"""docs AS (
  SELECT e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv AS cnpj, coalesce(c.razao_social, '') AS razao_social,
    coalesce(e.nome_fantasia, '') AS nome_fantasia, coalesce(e.uf, '') AS uf, coalesce(e.cnae_fiscal_principal, 0) AS cnae
  FROM {branch} e LEFT JOIN {company} c ON e.cnpj_basico = c.cnpj_basico)
"""


def _first(condition: str, q: str) -> str:
    return f"(SELECT '{q}' AS q, {DOC_COLS} FROM docs WHERE {condition} ORDER BY cnpj LIMIT {LIMIT})"


def _holds(q: str, text: str = "lower({})") -> str:
    return " OR ".join(f"{text.format(c)} LIKE '%{q}%'" for c in ("razao_social", "nome_fantasia"))


def _asked(found: dict[str, DataFrame]) -> DataFrame:
    out = None
    for q, df in found.items():
        one = df.select(F.lit(q).alias("q"), "cnpj", "razao_social", "nome_fantasia", "uf", "cnae")
        out = one if out is None else out.unionByName(one)
    return out


def _state(store: Store) -> tuple[dict[str, DataFrame], SearchIndex]:
    commits = store.commits()
    idx = committed_index(store, commits)
    if idx is None:
        raise RuntimeError("the postings are behind the data")
    return {t: store.read(t, TABLES[t].struct, commits) for t in NAMES}, idx


# ---- outdated postings ------------------------------------------------------------------

# Before, every company has another name; after, only one in 25 keeps it.
OLD_NAME = "concat('Antiga casa ', razao_social)"
RENAMED = f"SELECT * REPLACE (CASE WHEN CAST(cnpj_basico AS BIGINT) % 25 = 0 THEN {OLD_NAME} ELSE razao_social END AS razao_social) FROM fx_empresa"


def _renamed(fx: Fixtures) -> Store:
    """A store of two runs with postings, the second of which renames most companies."""
    store = Store(fx.spark, scratch_path(fx.spark, "outdated"))
    t = fx.registry()
    old = F.concat(F.lit("Antiga casa "), F.col("razao_social"))
    keeps = F.col("cnpj_basico").cast("bigint") % 25 == 0
    for month, name in ((PREV_MONTH, old), (CURR_MONTH, F.when(keeps, old).otherwise(F.col("razao_social")))):
        tx = store.begin(month)
        frames = {"empresa": t["empresa"].withColumn("razao_social", name)}
        if month == PREV_MONTH:
            frames["estabelecimento"] = t["estabelecimento"]
        upsert_tables(tx, frames, month, DETECTED_AT, order=None)
        index_changes(tx)
        tx.commit()
    return store


_OUTDATED_WITH = duckdb_with("fx_estabelecimento", "fx_empresa").rstrip() + f", renamed AS ({RENAMED}), " + _docs("renamed")


@register("k3_outdated_postings", _OUTDATED_WITH + "\nUNION ALL ".join(_first(_holds(q), q) for q in ("antiga", "omer#0", "blue")))
def k3_outdated_postings(fx: Fixtures):
    """K3: contains searches over postings of which most are outdated by a later run."""
    tables, idx = _state(_renamed(fx))
    return _asked({q: indexed_contains(tables, idx, q, None, LIMIT) for q in ("antiga", "omer#0", "blue")})


def _begins(q: str) -> str:
    tokens = lambda c: f"string_split_regex(lower({c}), '[^\\p{{L}}\\p{{N}}_]+')"
    return " OR ".join("(" + " AND ".join(f"len(list_filter({tokens(c)}, lambda k: starts_with(k, '{t}'))) > 0" for t in q.split()) + ")"
                       for c in ("razao_social", "nome_fantasia"))


@register("k4_outdated_postings", _OUTDATED_WITH + "\nUNION ALL ".join(_first(_begins(q), q) for q in ("antiga cas", "customer", "casa")))
def k4_outdated_postings(fx: Fixtures):
    """K4: prefix searches over postings of which most are outdated by a later run."""
    tables, idx = _state(_renamed(fx))
    return _asked({q: indexed_prefix(tables, idx, q, None, LIMIT) for q in ("antiga cas", "customer", "casa")})


# ---- search after a stream batch ----------------------------------------------------------

_STREAMED = duckdb_with("fx_estabelecimento_prev", "fx_empresa_prev", "fx_empresa_curr").rstrip() + """, company AS (
  SELECT cnpj_basico, razao_social FROM fx_empresa_curr UNION ALL
  SELECT cnpj_basico, razao_social FROM fx_empresa_prev p WHERE NOT EXISTS (SELECT 1 FROM fx_empresa_curr c WHERE c.cnpj_basico = p.cnpj_basico)),
""" + _docs("company", "fx_estabelecimento_prev")


@register("t2_stream_search", _STREAMED + "\nUNION ALL ".join(_first(_holds(q), q) for q in (" me", "0009", "blue")))
def t2_stream_search(fx: Fixtures):
    """T2 with K3: renamed companies are streamed into an indexed store and found by index."""
    root = scratch_path(fx.spark, "t2-search")
    store = Store(fx.spark, f"{root}/store")
    tx = store.begin(PREV_MONTH)
    before = fx.registry("_prev")
    upsert_tables(tx, {t: before[t] for t in NAMES}, PREV_MONTH, DETECTED_AT, order=None)
    index_changes(tx)
    tx.commit()
    spec = TABLES["empresa"]
    write_registry_csv(fx.registry("_curr")["empresa"], spec, f"{root}/src/{CURR_MONTH}", files=2)
    stream_upsert(ingest_stream(fx.spark, f"{root}/src", spec), store, spec, DETECTED_AT, f"{root}/ckpt", "t2-search")
    tables, idx = _state(store)
    return _asked({q: indexed_contains(tables, idx, q, None, LIMIT) for q in (" me", "0009", "blue")})


# ---- without accents (B10) ------------------------------------------------------------------

# Companies named after the first words of documents, with accents as letters or, in every
# third, as marks of their own, and some with letters of other alphabets' accents.
ACCENTED = """
SELECT lpad(CAST(doc_id AS STRING), 8, '0') AS cnpj_basico,
  CASE doc_id % 3 WHEN 0 THEN replace(replace(substr(text, 1, 60), 'é', concat('e', chr(769))), 'ó', concat('o', chr(769)))
    WHEN 1 THEN concat(substr(text, 1, 60), ' ŠKODA ŽIŽKOV Ệ') ELSE upper(substr(text, 1, 60)) END AS razao_social
FROM {documents} WHERE text IS NOT NULL"""


def _accented_registry(fx: Fixtures) -> dict[str, DataFrame]:
    company = fx.sql(ACCENTED.replace("chr(769)", "'́'"))
    branch = company.select("cnpj_basico", F.lit("0001").alias("cnpj_ordem"), F.lit("91").alias("cnpj_dv"))
    return {"empresa": conform(company, TABLES["empresa"]), "estabelecimento": conform(branch, TABLES["estabelecimento"])}


_ACCENTED_WITH = "WITH company AS (" + ACCENTED.replace("{documents}", "documents").replace("CAST(doc_id AS STRING)", "CAST(doc_id AS VARCHAR)") + """),
docs AS (SELECT cnpj_basico || '000191' AS cnpj, razao_social, '' AS nome_fantasia, '' AS uf, CAST(0 AS BIGINT) AS cnae FROM company)
"""
_PLAIN = "strip_accents(lower({}))"
FOLDED = ("eche", "skoda zizk", "cion", "ELÉ")


def _plain(q: str) -> str:
    return f"{_PLAIN.format('razao_social')} LIKE '%' || {_PLAIN.format(repr(q))} || '%'"


@register("b10_fold_contains", _ACCENTED_WITH + "\nUNION ALL ".join(_first(_plain(q), q) for q in FOLDED))
def b10_fold_contains(fx: Fixtures):
    """Q7 without accents over names with accents as letters and as marks."""
    t = _accented_registry(fx)
    return _asked({q: search_contains(t, q, None, LIMIT, fold_accents=True) for q in FOLDED})


@register("b10_fold_indexed", _ACCENTED_WITH + "\nUNION ALL ".join(_first(_plain(q), q) for q in FOLDED))
def b10_fold_indexed(fx: Fixtures):
    """B10 through K3: the same from postings that hold both kinds of terms."""
    t = _accented_registry(fx)
    idx = build_index(fx.spark, t, scratch_path(fx.spark, "b10-index"))
    return _asked({q: indexed_contains(t, idx, q, None, LIMIT, fold_accents=True) for q in FOLDED})

