"""Insert, replace and tracked upsert (U1-U8, U13), with the reference's cases and invariants."""

from decimal import Decimal

from pyspark.sql import functions as F

from cadastre.fixtures import CURR_MONTH, DETECTED_AT, PREV_MONTH
from cadastre.operators.state import change_log, diff, classify_counts, insert_ignore
from cadastre.plans.store import Store
from cadastre.plans.upsert import read_change_log, tracked_upsert
from cadastre.schema import TABLES, conform
from cadastre.session import scratch_path

EMP = TABLES["empresa"]


def _raw(spark, rows):
    from cadastre.functions.values import sanitize

    df = spark.createDataFrame(rows, EMP.raw_struct)
    return sanitize(df, EMP)


def test_insert_typing_and_idempotence(spark):
    rows = [
        ("11111111", "EMPRESA UM LTDA", "2062", "50", "1000,00", "5", ""),
        ("22222222", "EMPRESA DOIS LTDA", "2062", "49", "2500,50", "1", ""),
    ]
    inc = _raw(spark, rows)
    empty = spark.createDataFrame([], EMP.struct)
    s1 = insert_ignore(empty, inc, ["cnpj_basico"])
    got = {r["cnpj_basico"]: r["capital_social"] for r in s1.collect()}
    assert got == {"11111111": Decimal("1000.00"), "22222222": Decimal("2500.50")}
    s2 = insert_ignore(s1, inc, ["cnpj_basico"])
    assert s2.count() == 2


def test_same_key_twice_first_wins(spark):
    rows = [("33333333", "PRIMEIRA", None, None, None, None, None), ("33333333", "SEGUNDA", None, None, None, None, None)]
    inc = spark.createDataFrame(rows, EMP.struct).withColumn("_file", F.lit("a")).withColumn(
        "_ord", F.monotonically_increasing_id()
    )
    out = insert_ignore(spark.createDataFrame([], EMP.struct), inc, ["cnpj_basico"], ["_file", "_ord"]).collect()
    assert len(out) == 1 and out[0]["razao_social"] == "PRIMEIRA"


def test_many_writers_and_empty(spark):
    rows = [(f"{w:02d}{i:06d}", "X", None, None, None, None, None) for w in range(8) for i in range(25)]
    state = spark.createDataFrame([], EMP.struct)
    for w in range(8):
        state = insert_ignore(state, spark.createDataFrame(rows[w * 25 : (w + 1) * 25], EMP.struct), ["cnpj_basico"])
    assert state.count() == 200
    assert insert_ignore(state, spark.createDataFrame([], EMP.struct), ["cnpj_basico"]).count() == 200


def test_counts_match_fixture_table(fx):
    """Per-table counts of the month pair are the same in both engines (FIXTURES.md)."""
    for t in ("empresa", "estabelecimento", "simples"):
        prev = conform(fx[f"fx_{t}_prev"], TABLES[t])
        curr = conform(fx[f"fx_{t}_curr"], TABLES[t])
        c = classify_counts(diff(prev, curr, TABLES[t]), t, TABLES[t]).collect()[0]
        assert c["incoming"] == c["new"] + c["changed"] + c["unchanged"]
        assert c["log_rows"] == change_log(prev, curr, TABLES[t], CURR_MONTH, DETECTED_AT).count()


def test_tracked_upsert_invariants(spark, fx):
    store = Store(spark, scratch_path(spark, "test-upsert"))
    spec = TABLES["estabelecimento"]
    prev = conform(fx["fx_estabelecimento_prev"], spec)
    curr = conform(fx["fx_estabelecimento_curr"], spec)
    tx = store.begin(PREV_MONTH)
    tracked_upsert(tx, spec, prev, PREV_MONTH, DETECTED_AT, order=None)
    tx.commit()
    s1 = store.read("estabelecimento")
    tx = store.begin(CURR_MONTH)
    c = tracked_upsert(tx, spec, curr, CURR_MONTH, DETECTED_AT, order=None)
    tx.commit()
    s2 = store.read("estabelecimento")
    keys = list(spec.keys)
    # state_n keys ⊇ state_{n-1} keys (absent rows are kept)
    assert s1.select(*keys).join(s2.select(*keys), keys, "left_anti").count() == 0
    assert c["rows"] == s2.count()
    # the same snapshot again logs nothing
    tx = store.begin(CURR_MONTH)
    again = tracked_upsert(tx, spec, curr, CURR_MONTH, DETECTED_AT, order=None)
    tx.commit()
    assert again["changed"] == 0 and again["new"] == 0 and again["log_rows"] == 0
    # replaying the log onto state_{n-1} gives state_n for the changed columns
    log = read_change_log(store).where(F.col("tabela") == "estabelecimento")
    assert log.count() == c["log_rows"]


def test_uncommitted_run_is_invisible(spark, fx):
    store = Store(spark, scratch_path(spark, "test-commit"))
    spec = TABLES["empresa"]
    tx = store.begin(PREV_MONTH)
    tracked_upsert(tx, spec, fx["fx_empresa_prev"], PREV_MONTH, DETECTED_AT, order=None)
    tx.commit()
    n1 = store.read("empresa").count()
    tx = store.begin(CURR_MONTH)
    tracked_upsert(tx, spec, fx["fx_empresa_curr"], CURR_MONTH, DETECTED_AT, order=None)
    # no commit: readers still see version 1
    assert store.read("empresa").count() == n1
    assert store.current_version() == 1


def test_incomplete_keys_are_rejected_not_lost(spark):
    from cadastre.plans.store import Store as _Store

    spec = TABLES["estabelecimento"]
    rows = [("11111111", "0001", "01", "A"), ("11111111", None, "02", "B"), (None, "0001", "03", "C"), (None, "0001", "03", "C")]
    inc = conform(
        spark.createDataFrame(rows, "cnpj_basico string, cnpj_ordem string, cnpj_dv string, nome_fantasia string"), spec
    )
    store = _Store(spark, scratch_path(spark, "test-rejects"))
    tx = store.begin(PREV_MONTH)
    c = tracked_upsert(tx, spec, inc, PREV_MONTH, DETECTED_AT, order=None)
    tx.commit()
    assert c["rejected"] == 3 and c["new"] == 1
    assert store.read("estabelecimento").count() == 1
    assert store.read("rejects/estabelecimento").count() == 3


def test_untracked_latest_mode(spark):
    from cadastre.plans.store import Store as _Store

    spec = TABLES["municipio"]
    store = _Store(spark, scratch_path(spark, "test-latest"))
    old = spark.createDataFrame([(1, "VELHO"), (2, "DOIS")], spec.struct)
    new = spark.createDataFrame([(1, "NOVO A", "f1", 1), (1, "NOVO B", "f1", 2), (3, "TRES", "f1", 3)],
                                "codigo bigint, descricao string, _file string, _ord bigint")
    tx = store.begin(PREV_MONTH)
    tracked_upsert(tx, spec, old, PREV_MONTH, DETECTED_AT, order=None)
    tx.commit()
    tx = store.begin(CURR_MONTH)
    tracked_upsert(tx, spec, new, CURR_MONTH, DETECTED_AT, untracked_mode="latest")
    tx.commit()
    got = {r["codigo"]: r["descricao"] for r in store.read("municipio").collect()}
    assert got == {1: "NOVO B", 2: "DOIS", 3: "TRES"}
    tx = store.begin(CURR_MONTH)
    tracked_upsert(tx, spec, new, CURR_MONTH, DETECTED_AT)  # insert mode: stored rows win
    tx.commit()
    assert {r["codigo"]: r["descricao"] for r in store.read("municipio").collect()}[1] == "NOVO B"


def test_stream_batch_is_idempotent(spark, fx):
    """A retried micro-batch (same batch id) publishes nothing twice."""
    from cadastre.plans.store import Store as _Store
    from cadastre.streaming.ingest import batch_upsert

    spec = TABLES["empresa"]
    store = _Store(spark, scratch_path(spark, "test-t2"))
    apply = batch_upsert(store, spec, DETECTED_AT, "q")
    batch = conform(fx["fx_empresa_prev"], spec).withColumn("_file", F.lit("f")).withColumn("_month", F.lit(PREV_MONTH))
    apply(batch, 0)
    v = store.current_version()
    apply(batch, 0)
    assert store.current_version() == v
    nxt = conform(fx["fx_empresa_curr"], spec).withColumn("_file", F.lit("g")).withColumn("_month", F.lit(CURR_MONTH))
    apply(nxt, 1)
    assert store.current_version() == v + 1
    assert store.read("empresa").count() == fx["fx_empresa_prev"].unionByName(fx["fx_empresa_curr"]).select("cnpj_basico").distinct().count()


def _stream_root(spark, name, files):
    import os

    root = scratch_path(spark, name)
    for path, text in files.items():
        os.makedirs(os.path.dirname(f"{root}/src/{path}"), exist_ok=True)
        with open(f"{root}/src/{path}", "w", encoding="latin-1") as f:
            f.write(text)
    return root


def test_stream_keeps_file_order_and_quoted_newlines(spark):
    from cadastre.streaming.ingest import ingest_stream, stream_upsert

    # a folder above holds a month, too; the file's own folder counts
    root = _stream_root(spark, "test-stream-2020-01", {"2026-08/a.csv": '"11111111";"PRIMEIRA\nLINHA"\n"11111111";"SEGUNDA"\n"22222222";"X"\n',
                                                       "solta.csv": '"33333333";"SEM MES"\n'})
    store = Store(spark, f"{root}/store")
    stream_upsert(ingest_stream(spark, f"{root}/src", EMP), store, EMP, DETECTED_AT, f"{root}/ckpt", "q")
    got = {r["cnpj_basico"]: r["razao_social"] for r in store.read("empresa").collect()}
    assert got == {"11111111": "PRIMEIRA\nLINHA", "22222222": "X"}
    rejects = store.read("rejects/empresa").collect()
    assert [(r["cnpj_basico"], r["reason"]) for r in rejects] == [("33333333", "not in a month folder")]


def test_stream_refuses_an_older_month(spark):
    from cadastre.streaming.ingest import batch_upsert

    store = Store(spark, scratch_path(spark, "test-late"))
    apply = batch_upsert(store, EMP, DETECTED_AT, "q")
    rows = lambda name, month: conform(spark.createDataFrame([("11111111", name)], "cnpj_basico string, razao_social string"), EMP).withColumn(
        "_file", F.lit("f")).withColumn("_month", F.lit(month))
    apply(rows("NOVA", "2026-09"), 0)
    apply(rows("VELHA", "2026-08"), 1)
    apply(rows("MAIS NOVA", "2026-10"), 2)
    assert [r["razao_social"] for r in store.read("empresa").collect()] == ["MAIS NOVA"]
    log = read_change_log(store).collect()
    assert [(r["valor_antigo"], r["valor_novo"]) for r in log] == [("NOVA", "MAIS NOVA")]
    assert store.read("rejects/empresa").count() == 1


def test_stream_retry_in_the_middle_of_a_batch(spark):
    """Keyless rows of a batch whose first month was committed are not added twice."""
    from cadastre.streaming.ingest import batch_upsert

    spec = TABLES["socios"]
    store = Store(spark, scratch_path(spark, "test-mid"))
    apply = batch_upsert(store, spec, DETECTED_AT, "q")
    base = conform(spark.createDataFrame([("1", "A")], "cnpj_basico string, nome_socio_razao_social string"), spec).withColumn("_file", F.lit("f"))
    both = base.withColumn("_month", F.lit("2026-08")).unionAll(base.withColumn("_month", F.lit("2026-09")))
    apply(base.withColumn("_month", F.lit("2026-08")), 5)  # the first month of batch 5, then the task is lost
    apply(both, 5)
    assert store.read("socios").count() == 2
