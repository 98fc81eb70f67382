"""Q2 from footers, Q3 from sketches, and T3's decisions in a stream."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from cadastre.fixtures import DETECTED_AT
from cadastre.operators.reads import SKETCH_ERROR, key_sketch, rows_in_footers, stats_from_sketches
from cadastre.plans.store import Store
from cadastre.plans.upsert import read_sketches, upsert_tables
from cadastre.registry import Registry
from cadastre.schema import TABLES, conform
from cadastre.session import scratch_path
from cadastre.streaming.ingest import run_available
from cadastre.streaming.quota import quota, quota_decisions

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def test_footers(spark):
    d = scratch_path(spark, "footers")
    spark.range(1000).repartition(7).write.parquet(f"{d}/seven")
    spark.range(0).write.parquet(f"{d}/none")
    got = rows_in_footers(spark, {"seven": f"{d}/seven", "none": f"{d}/none", "two": [f"{d}/seven", f"{SF}/nation.parquet"][:1], "absent": f"{d}/absent"})
    assert {r["tabela"]: (r["files"], r["rows"]) for r in got.collect()} == {"seven": (7, 1000), "none": (0, 0), "two": (7, 1000), "absent": (0, 0)}
    text = plan_of(rows_in_footers(spark, {"l": f"{SF}/lineitem.parquet"}))
    assert "ReadSchema: struct<>" in text


@pytest.mark.parametrize("n", [0, 10, 1000, 60_000])
def test_sketches_unite(spark, n):
    parts = [spark.range(lo, hi).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("l")) for lo, hi in ((0, n), (n // 2, n + n // 2))]
    sketches = None
    for p in parts:
        one = p.agg(key_sketch(["k", "l"]).alias("sketch"))
        sketches = one if sketches is None else sketches.unionByName(one)
    got = stats_from_sketches({"t": sketches}).first()["estimate"]
    exact = n + n // 2
    assert abs(got - exact) <= SKETCH_ERROR * exact
    assert SKETCH_ERROR < 0.05


def test_sketch_of_each_load(spark):
    base = scratch_path(spark, "sketches")
    store, reg = Store(spark, base), Registry(spark, base)
    assert {r["tabela"]: r["estimate"] for r in stats_from_sketches(read_sketches(store)).collect()} == {"empresa": 0, "estabelecimento": 0}
    for month, keys in (("2026-01", range(100)), ("2026-02", range(50, 150))):
        tx = store.begin(month)
        rows = [(f"{k:08d}", f"N{k}") for k in keys] + [(None, "no key")]
        upsert_tables(tx, {"empresa": conform(spark.createDataFrame(rows, "cnpj_basico string, razao_social string"), TABLES["empresa"])}, month, DETECTED_AT, order=None)
        tx.commit()
    assert store.rows("sketch/empresa") == 2
    got = {r["tabela"]: r["estimate"] for r in reg.stats("approximate").collect()}
    assert abs(got["empresa"] - 150) <= SKETCH_ERROR * 150 + 1 and store.rows("empresa") == 150


EVENTS = [(i, f"u{i % 3}" if i % 2 else "hot", dt.datetime(2026, 1, 1, i // 20, (i * 7) % 60, i % 60)) for i in range(200)]
SCHEMA = "event_id bigint, user_id string, ts timestamp_ntz"


def decisions(df):
    return sorted((r["event_id"], r["user_id"], r["window_id"], r["allowed"], r["retry_after"]) for r in df.collect())


def test_decisions_of_one_batch(spark):
    d = scratch_path(spark, "decide")
    df = spark.createDataFrame([*EVENTS, EVENTS[5], EVENTS[5]], SCHEMA)  # a repeated event is one more request
    df.repartition(3).write.parquet(f"{d}/src")
    for limit in (0, 1, 5):
        stream = spark.readStream.schema(df.schema).parquet(f"{d}/src")
        run_available(quota_decisions(stream, "user_id", "ts", "event_id", 3600, limit, "1 hour"), f"{d}/sink{limit}", f"{d}/ckpt{limit}")
        assert decisions(spark.read.parquet(f"{d}/sink{limit}")) == decisions(quota(df, "user_id", "ts", "event_id", 3600, limit))


def test_decisions_after_a_restart(spark):
    """State outlives the query: what a window has used is known to the next run; late requests are dropped."""
    d = scratch_path(spark, "restart")
    df = spark.createDataFrame(sorted(EVENTS, key=lambda e: (e[2], e[0])), SCHEMA)
    halves = [df.where("event_id < 110"), df.where("event_id >= 110")]
    order = [spark.createDataFrame(sorted(h.collect(), key=lambda e: e["ts"]), SCHEMA) for h in halves]
    for i, half in enumerate(order):
        half.coalesce(1).write.mode("append").parquet(f"{d}/src")
        stream = spark.readStream.schema(df.schema).parquet(f"{d}/src")
        run_available(quota_decisions(stream, "user_id", "ts", "event_id", 6 * 3600, 4, "5 hours"), f"{d}/sink", f"{d}/ckpt")
        got = spark.read.parquet(f"{d}/sink")
        if i == 0:
            assert got.count() == 110
    # within a window the first batch's requests come first
    assert got.count() == 200
    both = order[0].withColumn("b", F.lit(0)).unionByName(order[1].withColumn("b", F.lit(1)))
    used: dict = {}
    want = {}
    for r in sorted(both.collect(), key=lambda r: (r["b"], r["ts"], r["event_id"])):
        key = (r["user_id"], int((r["ts"] - dt.datetime(1970, 1, 1)).total_seconds()) // (6 * 3600))
        used[key] = used.get(key, 0) + 1
        want[r["event_id"]] = used[key] <= 4
    assert {r["event_id"]: r["allowed"] for r in got.collect()} == want
    late = spark.createDataFrame([(999, "u1", dt.datetime(2025, 12, 1))], SCHEMA)
    late.coalesce(1).write.mode("append").parquet(f"{d}/src")
    stream = spark.readStream.schema(df.schema).parquet(f"{d}/src")
    run_available(quota_decisions(stream, "user_id", "ts", "event_id", 6 * 3600, 4, "5 hours"), f"{d}/sink", f"{d}/ckpt")
    assert spark.read.parquet(f"{d}/sink").where("event_id = 999").count() == 0


def test_layouts_answer_until_the_data_changes(spark, fx):
    base = scratch_path(spark, "laid-out")
    reg, t = Registry(spark, base), fx.registry()

    def load(month, tables):
        tx = reg.store.begin(month)
        upsert_tables(tx, tables, month, DETECTED_AT, order=None)
        tx.commit()

    load("2026-01", {n: t[n] for n in ("empresa", "estabelecimento", "simples", "cnae", "municipio", "motivo_situacao_cadastral", "natureza_juridica")})
    rows = lambda df: sorted(map(repr, df.collect()))
    plain, found = rows(reg.view()), rows(reg.search_in("am", "ring", 50))
    reg.lay_out()
    view = reg.view()
    assert plan_of(view).count("Bucketed: true") >= 3 and rows(view) == plain
    assert "PartitionFilters: [isnotnull(uf" in plan_of(reg.search_in("am", "ring")) and rows(reg.search_in("am", "ring", 50)) == found
    request = spark.createDataFrame([("00000001000001",)], "requested string")
    laid = rows(reg.profiles(request).drop("cnpj_basico", "cnpj_ordem", "cnpj_dv"))
    load("2026-02", {"empresa": t["empresa"].withColumn("razao_social", F.lit("OUTRA"))})
    changed = reg.view()
    assert "Bucketed: true" not in plan_of(changed) and {r["razao_social"] for r in changed.collect()} <= {"OUTRA", None}
    assert len(laid) == 1 and reg.search_in("am", "outra", 5).count() == 5


def test_decisions_call_python_for_many_keys_at_once(spark):
    """Keys of a window share a few groups of state; nulls among them are a key of their own."""
    d = scratch_path(spark, "slots")
    ts = dt.datetime(2026, 1, 1)
    rows = [(i, None if i % 50 == 0 else 2**60 + i % 400, ts + dt.timedelta(seconds=i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts timestamp_ntz")
    df.coalesce(1).write.parquet(f"{d}/src")
    decide = lambda n: run_available(quota_decisions(
        spark.readStream.schema(df.schema).parquet(f"{d}/src"), "user_id", "ts", "event_id", 86_400, 3, "1 hour", slots=n), f"{d}/sink{n}", f"{d}/ckpt{n}")
    for n in (1, 8):
        decide(n)
        got = spark.read.parquet(f"{d}/sink{n}")
        named = "user_id IS NOT NULL"
        assert decisions(got.where(named)) == decisions(quota(df.where(named), "user_id", "ts", "event_id", 86_400, 3))
        assert sorted(r["event_id"] for r in got.where("user_id IS NULL AND allowed").collect()) == [0, 50, 100] and got.count() == 2000
        state = spark.read.format("statestore").load(f"{d}/ckpt{n}")
        assert 0 < state.count() <= n + 1  # one for all keys of a slot, and that of nulls
