"""What loads leave on disk beside the store, and how their input is staged."""

import gzip
import os
import zipfile

import pyarrow.parquet as pq

from cadastre.catalog import ingest, streams
from cadastre.fixtures import CURR_MONTH, DETECTED_AT, PREV_MONTH
from cadastre.plans import indexes
from cadastre.plans.run_month import run_month
from cadastre.plans.store import Store
from cadastre.schema import TABLES
from cadastre.session import scratch_path
from cadastre.sources.archives import expand_archives
from cadastre.sources.csv import load_typed
from cadastre.streaming.ingest import batch_upsert


def files_under(path):
    return sorted(os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if not f.endswith(".crc"))


def test_a_month_leaves_its_store_and_export_only(spark, fx):
    root = scratch_path(spark, "left")
    store = Store(spark, f"{root}/store")
    for suffix, month in (("_prev", PREV_MONTH), ("_curr", CURR_MONTH)):
        archives = ingest.stage_month(fx, suffix, month, root)
        done = run_month(spark, store, archives, month, DETECTED_AT, f"{root}/staging")
    assert files_under(f"{root}/csv") == files_under(f"{root}/staging") == files_under(f"{root}/store/data/delta") == []
    assert all(os.path.exists(a) for a in archives)  # the archives are the caller's
    made = files_under(f"{done['export']}/documents")
    assert [f for f in made if f.endswith(".json.gz")] and not [f for f in made if f.endswith(".json")]
    # both runs' documents are there, read by the names of the newest version
    assert store.read("estabelecimento", TABLES["estabelecimento"].struct).count() == spark.read.json(f"{done['export']}/documents").count()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_small_members_are_expanded_with_gzip(spark, tmp_path):
    text = {"A.EMPRECSV": '"1";"UM"\n' * 3, "B.EMPRECSV": '"2";"DOIS"\n' * 400, "C.EMPRECSV.gz": gzip.compress(b'"3";"TRES"\n')}
    with zipfile.ZipFile(tmp_path / "E.zip", "w") as z:
        for name, data in text.items():
            z.writestr(name, data)
    listed = spark.createDataFrame([(str(tmp_path / "E.zip"),)], "archive string")
    found = {r["member"]: r for r in expand_archives(listed, str(tmp_path / "out"), compress=100).collect()}
    assert sorted(files_under(tmp_path / "out")) == ["E/A.EMPRECSV.gz", "E/B.EMPRECSV", "E/C.EMPRECSV.gz"]
    assert {m: r["bytes"] for m, r in found.items()} == {m: len(data) for m, data in text.items()}
    rows = load_typed(spark, [r["path"] for r in found.values()], TABLES["empresa"], "auto").groupBy("razao_social").count().collect()
    assert {tuple(r) for r in rows} == {("UM", 3), ("DOIS", 400), ("TRES", 1)}


def test_lists_are_kept_as_differences(spark, fx):
    base = scratch_path(spark, "lists")
    indexes.build_index(spark, fx.registry(), base)
    for kind in indexes.KINDS:
        file = next(f for f in files_under(f"{base}/{kind}") if f.endswith(".parquet"))
        chunks = pq.ParquetFile(f"{base}/{kind}/{file}").metadata.row_group(0)
        docs = next(c for c in map(chunks.column, range(chunks.num_columns)) if c.path_in_schema.startswith("docs"))
        assert "DELTA_BINARY_PACKED" in docs.encodings and docs.compression == "ZSTD"


def test_a_stream_is_staged_in_more_files(fx, monkeypatch):
    made = []
    monkeypatch.setattr(streams, "scratch_path", lambda spark, label: made.append(scratch_path(spark, label)) or made[-1])
    monkeypatch.setattr(streams, "STREAMED_BYTES", 10_000)
    assert streams.t2_stream_upsert(fx).count() > 0
    files = [f for f in files_under(f"{made[0]}/src") if f.endswith(".csv")]
    assert min(sum(f.startswith(m) for f in files) for m in (PREV_MONTH, CURR_MONTH)) > 2


def test_a_batch_is_neither_cached_nor_left(spark, fx, monkeypatch):
    from cadastre.plans import upsert

    store, held = Store(spark, f"{scratch_path(spark, 'batch')}/store"), []
    own = upsert.tracked_upsert

    def seen(tx, spec, rows, *more):
        held.append((spark.sparkContext._jsc.getPersistentRDDs().size(), len(rows.inputFiles())))
        return own(tx, spec, rows, *more)

    monkeypatch.setattr(upsert, "tracked_upsert", seen)
    rows = fx.registry("_prev")["empresa"].selectExpr("*", "'a' AS _file", f"'{PREV_MONTH}' AS _month")
    batch_upsert(store, TABLES["empresa"], DETECTED_AT, "q")(rows, 0)
    assert held[0][0] == 0 and held[0][1] > 0
    assert store.read("empresa", TABLES["empresa"].struct).count() == rows.count() and files_under(f"{store.base}/data/delta") == []


def test_a_snapshot_is_shuffled_once(spark, fx):
    from cadastre.operators.state import compare_incoming
    from cadastre.plans.upsert import dedupe_snapshot

    spec = TABLES["estabelecimento"]
    incoming = fx.registry("_curr")["estabelecimento"].selectExpr("*", "'a' AS _file", "1 AS _ord").localCheckpoint()
    stored = fx.registry("_prev")["estabelecimento"].localCheckpoint()
    df = compare_incoming(stored.hint("merge"), dedupe_snapshot(incoming, spec, ["_file", "_ord"]), spec)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan
