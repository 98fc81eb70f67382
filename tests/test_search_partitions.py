"""Searches over many files with the keys in descending order, held against a
full sort; an index that outdated postings have been left in."""

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadastre.fixtures import DETECTED_AT
from cadastre.operators.reads import search_documents
from cadastre.operators.search import (
    KEYS3,
    fuzzy_column_score,
    fuzzy_words,
    search,
    search_contains,
    search_fuzzy,
    search_prefix,
)
from cadastre.plans.indexes import build_index, committed_index, fetch, index_changes, indexed_contains, indexed_fuzzy, indexed_prefix
from cadastre.plans.store import Store
from cadastre.plans.upsert import upsert_tables
from cadastre.schema import TABLES, conform
from cadastre.session import scratch_path


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def many(spark, fx):
    """The registry in eight files a table, the largest keys first."""
    base = scratch_path(spark, "many-files")
    t = fx.registry()
    for name, keys in (("estabelecimento", KEYS3), ("empresa", ["cnpj_basico"])):
        rows = t[name].withColumn("_p", F.ntile(8).over(Window.orderBy(*[F.desc(k) for k in keys])))
        for p in range(1, 9):
            rows.where(F.col("_p") == p).drop("_p").coalesce(1).write.parquet(f"{base}/{name}/{p}")
        paths = [f"{base}/{name}/{p}" for p in range(1, 9)]
        t[name] = spark.read.parquet(paths[0])
        for p in paths[1:]:
            t[name] = t[name].unionAll(spark.read.parquet(p))
    assert t["estabelecimento"].rdd.getNumPartitions() >= 8
    return t


@pytest.fixture(scope="module")
def docs(many):
    return sorted(tuple(r) for r in search_documents(many, ordered=False).collect())


def contains(docs, q, uf=None):
    return [d for d in docs if (q in d[1].lower() or q in d[2].lower()) and (not uf or d[3] == uf)]


def prefix(docs, q):
    import re

    tokens = lambda s: re.split(r"[^\w]+", s.lower())
    holds = lambda s: all(any(x.startswith(t) for x in tokens(s)) for t in q.split())
    return [d for d in docs if holds(d[1]) or holds(d[2])]


def fuzzy(many, q, k):
    e = many["estabelecimento"].join(many["empresa"].select("cnpj_basico", "razao_social"), "cnpj_basico", "left")
    score = F.greatest(fuzzy_column_score("razao_social", fuzzy_words(q)), fuzzy_column_score("nome_fantasia", fuzzy_words(q)))
    rows = e.select(F.concat(*KEYS3).alias("cnpj"), score.alias("score")).where("score is not null").collect()
    return [(r["cnpj"], r["score"]) for r in sorted(rows, key=lambda r: (-r["score"], r["cnpj"]))[:k]]


@pytest.mark.parametrize("k", [5, 20, 100])
def test_searches_give_the_first_keys(spark, many, docs, k):
    idx = build_index(spark, many, scratch_path(spark, "many-index"))
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(search_contains(many, "ring", None, k)) == contains(docs, "ring")[:k]
    assert rows(search_contains(many, "ring", "am", k)) == contains(docs, "ring", "AM")[:k]
    assert rows(search(many, "an", None, k).drop("source")) == contains(docs, "an")[:k]
    assert rows(search_prefix(many, "blue wid", None, k)) == prefix(docs, "blue wid")[:k]
    assert rows(indexed_contains(many, idx, "ring", "am", k)) == contains(docs, "ring", "AM")[:k]
    assert rows(indexed_prefix(many, idx, "blue wid", None, k)) == prefix(docs, "blue wid")[:k]
    for form in (search_fuzzy(many, "widgte", None, k), indexed_fuzzy(many, idx, "widgte", None, k)):
        got = sorted(((r["cnpj"], r["score"]) for r in form.collect()), key=lambda x: (-x[1], x[0]))
        assert got == fuzzy(many, "widgte", k)


def test_top_k_is_one_ordered_limit(many):
    """No limit is taken before rows of all partitions are compared."""
    for df in (search_contains(many, "ring", "am", 20), search_prefix(many, "blue wid", None, 20)):
        text = plan_of(df)
        assert "TakeOrderedAndProject" in text and "GlobalLimit" not in text and "CollectLimit" not in text


def test_index_reads_documents_by_literal_key(many):
    text = plan_of(fetch(many, [("00000001", "0000", "01")]))
    assert text.count("In(cnpj_basico") + text.count("EqualTo(cnpj_basico") >= 2


def test_index_follows_the_runs(spark, fx):
    """Postings of new and changed documents only; a renamed one is found by its
    new name and no longer by the old."""
    store = Store(spark, scratch_path(spark, "index-runs"))
    frames = lambda emp, est: {
        "empresa": conform(spark.createDataFrame(emp, "cnpj_basico string, razao_social string"), TABLES["empresa"]),
        "estabelecimento": conform(spark.createDataFrame(est, "cnpj_basico string, cnpj_ordem string, cnpj_dv string, nome_fantasia string, uf string"), TABLES["estabelecimento"])}

    def run(month, emp, est):
        tx = store.begin(month)
        upsert_tables(tx, frames(emp, est), month, DETECTED_AT, order=None)
        n = index_changes(tx)
        tx.commit()
        return n

    emp = [(f"{i:08d}", f"PADARIA NUMERO {i}") for i in range(30)]
    est = [(f"{i:08d}", "0001", "01", f"LOJA {i}", "SP") for i in range(30)]
    first = run("2026-01", emp, est)
    assert first > 0
    assert run("2026-02", emp, est) == 0  # nothing changed, nothing written
    emp2 = [(k, n.replace("PADARIA", "MERCADO") if int(k) < 10 else n) for k, n in emp]
    est2 = [(a, b, c, "FEIRA CENTRAL" if int(a) == 20 else n, "RJ" if int(a) == 21 else u) for a, b, c, n, u in est]
    assert 0 < run("2026-03", emp2, est2) < first
    commits = store.commits()
    t = {n: store.read(n, TABLES[n].struct, commits) for n in ("empresa", "estabelecimento")}
    idx = committed_index(store, commits)
    for q, uf, k in (("padaria", None, 5), ("padaria", None, 100), ("mercado", None, 100), ("loja", "SP", 100), ("feira central", None, 20)):
        want = sorted(tuple(r) for r in search_contains(t, q, uf, k).collect())
        assert sorted(tuple(r) for r in indexed_contains(t, idx, q, uf, k).collect()) == want, q
        want = sorted(tuple(r) for r in search_prefix(t, q, uf, k).collect())
        assert sorted(tuple(r) for r in indexed_prefix(t, idx, q, uf, k).collect()) == want, q
        want = sorted(tuple(r) for r in search_fuzzy(t, q, uf, k).collect())
        assert sorted(tuple(r) for r in indexed_fuzzy(t, idx, q, uf, k).collect()) == want, q


def test_fold_accents(spark):
    emp = conform(spark.createDataFrame([("00000001", "AÇÚCAR E PÃO")], "cnpj_basico string, razao_social string"), TABLES["empresa"])
    est = conform(spark.createDataFrame([("00000001", "0001", "01")], "cnpj_basico string, cnpj_ordem string, cnpj_dv string"), TABLES["estabelecimento"])
    t = {"empresa": emp, "estabelecimento": est}
    assert search_contains(t, "acucar", None, 5).count() == 0
    assert search_contains(t, "acucar", None, 5, fold_accents=True).count() == 1
    assert search_contains(t, "açucar e pao", None, 5, fold_accents=True).count() == 1
