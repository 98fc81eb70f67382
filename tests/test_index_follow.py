"""Postings that follow the data: dead postings, streams, runs without an index, folding."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from cadastre.fixtures import DETECTED_AT
from cadastre.functions import without_accents, without_accents_py
from cadastre.operators.search import search_contains, search_fuzzy, search_prefix
from cadastre.plans.indexes import build_index, committed_index, index_changes, indexed_contains, indexed_fuzzy, indexed_prefix
from cadastre.plans.store import Store
from cadastre.plans.upsert import upsert_tables
from cadastre.registry import Registry
from cadastre.schema import TABLES, conform
from cadastre.session import scratch_path
from cadastre.sources.csv import write_registry_csv
from cadastre.streaming.ingest import batch_upsert, ingest_stream, stream_upsert

EMP = TABLES["empresa"]


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def frames(spark, emp=None, est=None):
    out = {}
    if emp is not None:
        out["empresa"] = conform(spark.createDataFrame(emp, "cnpj_basico string, razao_social string"), EMP)
    if est is not None:
        out["estabelecimento"] = conform(spark.createDataFrame(
            est, "cnpj_basico string, cnpj_ordem string, cnpj_dv string, nome_fantasia string, uf string"), TABLES["estabelecimento"])
    return out


def run(store, month, tables, index=True):
    tx = store.begin(month)
    upsert_tables(tx, tables, month, DETECTED_AT, order=None)
    n = index_changes(tx) if index else None
    tx.commit()
    return n


def state(store):
    commits = store.commits()
    return {n: store.read(n, TABLES[n].struct, commits) for n in ("empresa", "estabelecimento")}, committed_index(store, commits)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same_answers(store, queries, limits=(3, 100)):
    t, idx = state(store)
    assert idx is not None
    for q in queries:
        for k in limits:
            assert rows(indexed_contains(t, idx, q, None, k)) == rows(search_contains(t, q, None, k)), q
            assert rows(indexed_prefix(t, idx, q, None, k)) == rows(search_prefix(t, q, None, k)), q
            assert rows(indexed_fuzzy(t, idx, q, None, k)) == rows(search_fuzzy(t, q, None, k)), q


BRANCHES = [(f"{i:08d}", "0001", "01", f"LOJA {i}", "SP") for i in range(24)]


def test_most_postings_outdated(spark):
    """A name goes, comes back and goes again; one plan answers, with one ordered limit."""
    store = Store(spark, scratch_path(spark, "follow"))
    names = [[(f"{i:08d}", f"{word} {i}") for i in range(24)] for word in ("PADARIA", "MERCADO", "PADARIA CENTRAL", "MERCADO")]
    run(store, "2026-01", frames(spark, names[0], BRANCHES))
    for month, some in zip(("2026-02", "2026-03", "2026-04"), names[1:], strict=True):
        assert run(store, month, frames(spark, some[:20])) > 0
    same_answers(store, ("padaria", "mercado", "central", "padaria central", "loja", "mercadp"))
    t, idx = state(store)
    assert {r[0][:8] for r in rows(indexed_contains(t, idx, "padaria", None, 100))} == {f"{i:08d}" for i in range(20, 24)}
    dead = idx.read("gram").where("not alive").count()
    assert 0 < dead < idx.read("gram").count()
    text = plan_of(indexed_contains(t, idx, "padaria", None, 5))
    assert "TakeOrderedAndProject" in text and "LeftAnti" in text and "EqualTo(term" in text
    assert "/estabelecimento/" not in text and "/empresa/" not in text  # the tables are not read


def test_a_run_without_postings(spark):
    """Searches scan what the index does not hold yet; the next indexing run writes all anew."""
    base = scratch_path(spark, "behind")
    store, reg = Store(spark, base), Registry(spark, base)
    run(store, "2026-01", frames(spark, [(f"{i:08d}", f"PADARIA {i}") for i in range(24)], BRANCHES))
    run(store, "2026-02", frames(spark, [("00000003", "QUITANDA 3")]), index=False)
    assert state(store)[1] is None
    assert [r["cnpj"][:8] for r in reg.search("quitanda").collect()] == ["00000003"]
    run(store, "2026-03", frames(spark, [("00000004", "FEIRA 4")]))
    idx = state(store)[1]
    assert len(idx.paths["gram"]) == 1 and idx.read("gram").where("not alive").count() == 0
    same_answers(store, ("quitanda", "feira", "padaria"))


def test_stream_keeps_the_index(spark):
    """T2 on an indexed store: the streamed names are found, the old ones are not; a retried batch adds nothing."""
    root = scratch_path(spark, "stream-index")
    store = Store(spark, f"{root}/store")
    run(store, "2026-01", frames(spark, [(f"{i:08d}", f"PADARIA {i}") for i in range(24)], BRANCHES))
    write_registry_csv(frames(spark, [(f"{i:08d}", f"AÇOUGUE {i}") for i in range(5)])["empresa"], EMP, f"{root}/src/2026-02", files=2)
    stream_upsert(ingest_stream(spark, f"{root}/src", EMP), store, EMP, DETECTED_AT, f"{root}/ckpt", "q")
    same_answers(store, ("padaria", "açougue", "loja"))
    t, idx = state(store)
    assert len(rows(indexed_contains(t, idx, "açougue", None, 100))) == 5 and len(rows(indexed_contains(t, idx, "acougue", None, 100, True))) == 5
    before, version = idx.read("gram").count(), store.current_version()
    batch = ingest_stream(spark, f"{root}/src", EMP)  # the same files as one batch, under the id that is marked
    static = spark.read.schema(EMP.raw_struct).option("sep", ";").csv(f"{root}/src/2026-02").withColumns(
        {"_file": F.lit("f"), "_month": F.lit("2026-02")})
    assert batch.isStreaming
    batch_upsert(store, EMP, DETECTED_AT, "q")(static, 0)
    assert store.current_version() == version and state(store)[1].read("gram").count() == before


def test_stream_into_a_store_without_an_index(spark):
    root = scratch_path(spark, "stream-plain")
    store = Store(spark, f"{root}/store")
    write_registry_csv(frames(spark, [("00000001", "A")])["empresa"], EMP, f"{root}/src/2026-02", files=1)
    stream_upsert(ingest_stream(spark, f"{root}/src", EMP), store, EMP, DETECTED_AT, f"{root}/ckpt", "q")
    assert not store.has("index/gram") and store.rows("empresa") == 1


ACCENTS = ["AÇÚCAR E PÃO", "Café da Manhã", "CAFE DA MANHA", "Škoda Žižkov", "Ệ VIỆT", "Straße Øl", "İstanbul", "한국 커피"]


def test_folding_is_the_same_on_both_sides(spark):
    import unicodedata

    texts = [t for a in ACCENTS for t in (a, unicodedata.normalize("NFD", a), a.lower())]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", "t", without_accents("t").alias("f")).collect()
    for r in got:
        if "İ" not in r["t"] and "한" not in unicodedata.normalize("NFC", r["t"]):
            assert r["f"] == without_accents_py(r["t"])
            assert r["f"] == without_accents_py(unicodedata.normalize("NFC", r["t"]))
    assert without_accents_py("AÇÚCAR Škoda Ệ") == "acucar skoda e"


@pytest.mark.parametrize("form", ["NFC", "NFD"])
def test_folded_searches(spark, form):
    import unicodedata

    emp = [(f"{i:08d}", unicodedata.normalize(form, t)) for i, t in enumerate(ACCENTS)]
    t = frames(spark, emp, BRANCHES[: len(ACCENTS)])
    idx = build_index(spark, t, scratch_path(spark, "folded"))
    for q, want in (("acucar", 1), ("cafe", 2), ("CAFÉ", 2), ("skoda zizk", 1), ("viet", 1), ("pao", 1)):
        found = rows(search_contains(t, q, None, 10, fold_accents=True))
        assert len(found) == want and rows(indexed_contains(t, idx, q, None, 10, fold_accents=True)) == found
        if search_prefix(t, q, None, 10, fold_accents=True) is not None:
            assert rows(indexed_prefix(t, idx, q, None, 10, True)) == rows(search_prefix(t, q, None, 10, True))
        assert rows(indexed_fuzzy(t, idx, q, None, 10, True)) == rows(search_fuzzy(t, q, None, 10, True))
        assert rows(indexed_contains(t, idx, q, None, 10)) == rows(search_contains(t, q, None, 10))
