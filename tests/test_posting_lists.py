"""Posting lists: one row for a term and block, documents of the blocks found only."""

from pyspark.sql import functions as F

from cadastre.functions.posting_lists import BLOCK_BITS
from cadastre.operators.search import search_contains, search_prefix
from cadastre.plans.indexes import DOCUMENT, build_index, indexed_contains, indexed_prefix, postings
from cadastre.schema import TABLES, conform
from cadastre.session import scratch_path

NAMES = ["PADARIA São João", "aaaa", "é", "", None, "Straße 12", "𝔘𝔫𝔦 padaria", "x y"]


def numbered(spark, names, step):
    rows = [(7, i * step, f"{i:08d}", "0001", "01", None, n, None if i % 2 else "Loja", None, i * step >> BLOCK_BITS) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, DOCUMENT)


def test_a_row_for_a_term_and_block(spark):
    """No row for each document, as before: what is written and sorted does not grow with documents times terms."""
    docs = numbered(spark, NAMES * 8, 1 << (BLOCK_BITS - 3)).coalesce(1)
    rows = postings(docs, "gram").collect()
    assert len({(r["term"], r["block"]) for r in rows}) == len(rows)
    got = {(r["term"], (r["block"] << BLOCK_BITS) + d) for r in rows for d in r["docs"]}
    assert len(got) == sum(len(r["docs"]) for r in rows) and {(r["run"], r["alive"]) for r in rows} == {(7, True)}
    want = set()
    for r in docs.select("doc", F.lower("razao_social").alias("a"), F.lower("nome_fantasia").alias("b")).collect():
        for text in (r["a"] or "", r["b"] or ""):
            plain = text.translate(str.maketrans("ãéç", "aec"))
            want |= {(t[i : i + 3], r["doc"]) for t in (text, plain) for i in range(len(t) - 2)}
    assert got == want
    words = {(r["term"], (r["block"] << BLOCK_BITS) + d) for r in postings(docs, "token").collect() for d in r["docs"]}
    assert {t for t, d in words if d == 0} == {"padaria", "são", "joão", "sao", "joao", "loja"} and "" not in {t for t, _ in words}


def test_dead_lists_name_the_document_before(spark):
    docs, before = numbered(spark, ["MERCADO"], 1), numbered(spark, ["PADARIA"], 1).withColumn("run", F.lit(3).cast("bigint"))
    rows = {(r["term"], r["run"], r["alive"]) for r in postings(docs, "token", before).collect()}
    assert rows == {("mercado", 7, True), ("loja", 7, True), ("padaria", 3, False), ("loja", 3, False)}


def test_searches_over_posting_lists(spark):
    emp = conform(spark.createDataFrame([(f"{i:08d}", n) for i, n in enumerate(NAMES)], "cnpj_basico string, razao_social string"), TABLES["empresa"])
    est = conform(spark.createDataFrame([(f"{i:08d}", "0001", "01", "Loja") for i in range(8)],
                                        "cnpj_basico string, cnpj_ordem string, cnpj_dv string, nome_fantasia string"), TABLES["estabelecimento"])
    t = {"empresa": emp, "estabelecimento": est}
    idx = build_index(spark, t, scratch_path(spark, "lists"))
    assert idx.read("gram").count() < sum(r["n"] for r in idx.read("gram").select(F.size("docs").alias("n")).collect())
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    for q in ("padaria", "são", "loja", "nowhere"):
        assert rows(indexed_contains(t, idx, q, None, 5)) == rows(search_contains(t, q, None, 5)), q
        assert rows(indexed_prefix(t, idx, q, None, 5)) == rows(search_prefix(t, q, None, 5)), q
