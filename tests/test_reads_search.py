"""Read side: documents and paging, search forms, quota, ledger."""

from pyspark.sql import functions as F

from cadastre.operators.ledger import is_processed
from cadastre.operators.reads import page, search_documents
from cadastre.operators.search import search, search_contains, search_prefix
from cadastre.plans.indexes import build_index, indexed_contains, indexed_prefix
from cadastre.schema import FILE_LEDGER, TABLES
from cadastre.session import scratch_path
from cadastre.streaming.quota import quota


def _paired(spark, n=5):
    emp = spark.createDataFrame(
        [(f"{i:08d}", f"EMPRESA {i}", None, None, None, None, None) for i in range(n)], TABLES["empresa"].struct
    )
    from cadastre.schema import conform

    est = spark.createDataFrame(
        [(f"{i:08d}", "0001", "90", f"FANTASIA {i}", "SP", 6201500, 7107) for i in range(n)],
        "cnpj_basico string, cnpj_ordem string, cnpj_dv string, nome_fantasia string, uf string, "
        "cnae_fiscal_principal bigint, municipio bigint",
    )
    return {"empresa": emp, "estabelecimento": conform(est, TABLES["estabelecimento"])}


def test_documents_and_pages(spark):
    t = _paired(spark)
    docs = search_documents(t, ordered=False)
    p1 = page(docs, ["cnpj"], 0, 2).collect()
    assert len(p1) == 2 and p1[0]["has_more"] and p1[0]["cnpj"] == "00000000000190"
    p3 = page(docs, ["cnpj"], 4, 2).collect()
    assert len(p3) == 1 and not p3[0]["has_more"]
    r = p1[0].asDict()
    assert r["razao_social"] == "EMPRESA 0" and r["uf"] == "SP" and r["cnae"] == 6201500


def test_empty_tables(spark):
    empty = {"empresa": spark.createDataFrame([], TABLES["empresa"].struct),
             "estabelecimento": spark.createDataFrame([], TABLES["estabelecimento"].struct)}
    assert page(search_documents(empty, ordered=False), ["cnpj"], 0, 10).count() == 0


def test_uf_filter_upper_cased(spark):
    t = _paired(spark)
    assert search_contains(t, "fantasia", "sp", 20).count() == 5
    assert search_contains(t, "fantasia", "mg", 20).count() == 0


def test_indexes_equal_scans(spark, fx):
    t = fx.registry()
    idx = build_index(spark, t, scratch_path(spark, "test-index"))
    for q, uf in (("ring", None), ("ring", "am"), ("blue", None), ("000000", None)):
        a = sorted(tuple(r) for r in search_contains(t, q, uf, 100).collect())
        b = sorted(tuple(r) for r in indexed_contains(t, idx, q, uf, 100).collect())
        assert a == b
    for q in ("blue wid", "cust", "red"):
        a = sorted(tuple(r) for r in search_prefix(t, q, None, 100).collect())
        b = sorted(tuple(r) for r in indexed_prefix(t, idx, q, None, 100).collect())
        assert a == b


def test_cascade_sources(fx):
    t = fx.registry()
    assert {r["source"] for r in search(t, "an", None, 10).collect()} == {"contains"}
    assert {r["source"] for r in search(t, "blue wid", None, 10).collect()} <= {"prefix"}
    assert {r["source"] for r in search(t, "widgte", None, 10, ranked=True).collect()} == {"fuzzy"}


def test_quota_rules(spark):
    rows = [(i, f"2024-01-01 00:00:{i:02d}", 1) for i in range(4)]
    rows += [(10, "2024-01-01 00:00:00", 2), (11, "2024-01-01 00:00:01", 3)]
    rows += [(20, "2024-01-02 00:00:05", 1)]
    ev = spark.createDataFrame(rows, "event_id long, ts string, user_id long").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    out = {r["event_id"]: r for r in quota(ev, "user_id", "ts", "event_id", 86400, 3).collect()}
    assert [out[i]["allowed"] for i in range(4)] == [True, True, True, False]
    assert out[3]["retry_after"] == 86400 - 3
    assert out[10]["allowed"] and out[11]["allowed"]  # keys are independent
    assert out[20]["allowed"]  # budget resets in the next window


def test_quota_hot_key(spark):
    """One key holding most rows: the salted ranking still admits exactly `limit`."""
    rows = [(i, "2024-01-01 00:00:00", 7) for i in range(5000)]
    ev = spark.createDataFrame(rows, "event_id long, ts string, user_id long").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )
    out = quota(ev, "user_id", "ts", "event_id", 86400, 2)
    allowed = sorted(r["event_id"] for r in out.where("allowed").collect())
    assert allowed == [0, 1]


def test_quota_of_repeated_events(spark):
    """The same event row three times is three requests, not nine."""
    ev = spark.createDataFrame([(1, "2024-01-01 00:00:00", 7)] * 3 + [(2, "2024-01-01 00:00:01", 7)], "event_id long, ts string, user_id long")
    out = quota(ev.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "user_id", "ts", "event_id", 86400, 2).collect()
    assert sorted((r["event_id"], r["allowed"]) for r in out) == [(1, False), (1, True), (1, True), (2, False)]


def test_ledger_before_after(spark):
    ledger = spark.createDataFrame([], FILE_LEDGER)
    assert is_processed(ledger, "2026-08", "Empresas0.zip").count() == 0
    import datetime

    row = spark.createDataFrame([("2026-08", "Empresas0.zip", "SUCCESS", datetime.datetime(2026, 9, 1))], FILE_LEDGER)
    assert is_processed(ledger.unionByName(row), "2026-08", "Empresas0.zip").count() == 1


def test_indexed_fuzzy_equals_scan(spark, fx):
    from cadastre.operators.search import search_fuzzy
    from cadastre.plans.indexes import indexed_fuzzy

    t = fx.registry()
    idx = build_index(spark, t, scratch_path(spark, "test-fuzzy"))
    for q in ("widgte", "blue widgte", "smal rign", "custmer", "red"):
        a = sorted(tuple(r) for r in search_fuzzy(t, q, None, 50).collect())
        b = sorted(tuple(r) for r in indexed_fuzzy(t, idx, q, None, 50).collect())
        assert a == b, q


def test_keyset_paging_covers_all(spark):
    from cadastre.operators.reads import keyset_page

    t = _paired(spark, 7)
    docs = search_documents(t, ordered=False)
    seen, after = [], None
    while True:
        page_rows = keyset_page(docs, "cnpj", after, 3).collect()
        if not page_rows:
            break
        seen += [r["cnpj"] for r in page_rows]
        after = page_rows[-1]["cnpj"]
    assert seen == sorted(r["cnpj"] for r in docs.collect())


def test_single_term_indexed(spark, fx):
    t = fx.registry()
    idx = build_index(spark, t, scratch_path(spark, "test-one-term"))
    for q in ("rin", "wid"):
        a = sorted(tuple(r) for r in search_contains(t, q, None, 100).collect())
        b = sorted(tuple(r) for r in indexed_contains(t, idx, q, None, 100).collect())
        assert a == b
        a = sorted(tuple(r) for r in search_prefix(t, q, None, 100).collect())
        b = sorted(tuple(r) for r in indexed_prefix(t, idx, q, None, 100).collect())
        assert a == b
