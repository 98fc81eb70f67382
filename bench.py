"""Headline benchmark: prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (default 3), BENCH_DRIVER_MEMORY (default 8g).

What is timed (warm session, median of BENCH_REPS unless noted), like a
deployment would run it:

* ``u8_tracked_upsert`` — month n-1 published, then the tracked upsert of
  month n for the three tracked tables (state + change log + commit); also as
  ``u8_rows_per_sec`` (incoming snapshot rows / second).
* ``u13_run_month`` — one month end to end from zip archives (expand, route,
  read, type, upsert all eight tables, ledgers, commit); once.
* ``k34_index_build`` — trigram + token postings and vocabulary; once.
* queries over the **published** store (parquet written by the load, K2
  range layout): J1 view, Q5 documents, Q7 contains vs K3 indexed, Q8 prefix
  vs K4 indexed, Q10 fuzzy scan vs indexed, J2 bulk profiles and a single
  profile, Q4 bulk history, Q1 stats; T3 quota over ``events``.
* ``s8_read_csv`` — registry text → typed rows (``s8_rows_per_sec``).

Every timing forces the whole plan with a ``noop`` write (nothing collected).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cadastre.catalog.ingest import stage_month  # noqa: E402
from cadastre.catalog.search import CONTAINS_Q, CONTAINS_UF, FUZZY_Q, LIMIT, PREFIX_Q  # noqa: E402
from cadastre.fixtures import CURR_MONTH, DETECTED_AT, PREV_MONTH, Fixtures  # noqa: E402
from cadastre.operators.joins import profile, profiles, registry_view  # noqa: E402
from cadastre.operators.reads import change_history, search_documents, stats_exact  # noqa: E402
from cadastre.operators.search import search_contains, search_fuzzy, search_prefix  # noqa: E402
from cadastre.plans.indexes import build_index, indexed_contains, indexed_fuzzy, indexed_prefix  # noqa: E402
from cadastre.plans.run_month import run_month  # noqa: E402
from cadastre.plans.store import Store  # noqa: E402
from cadastre.plans.upsert import read_change_log, upsert_tables  # noqa: E402
from cadastre.registry import Registry  # noqa: E402
from cadastre.schema import TABLES, conform  # noqa: E402
from cadastre.session import get_spark, scratch_path  # noqa: E402
from cadastre.sources.archives import list_files  # noqa: E402
from cadastre.sources.csv import load_typed, write_registry_csv  # noqa: E402
from cadastre.streaming.quota import quota  # noqa: E402

TRACKED = ["empresa", "estabelecimento", "simples"]


def force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, reps: int) -> float:
    out = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t0)
    return statistics.median(out)


def publish(spark, fx: Fixtures, base: str, suffix: str, month: str, store: Store | None = None) -> Store:
    store = store or Store(spark, base)
    tx = store.begin(month)
    upsert_tables(tx, fx.registry(suffix), month, DETECTED_AT, order=None)
    tx.commit()
    return store


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = get_spark(f"local[{cpus}]", max(8, cpus * 2), app="cadastre-bench", **{"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    fx = Fixtures(spark, sf_dir)
    q: dict[str, float] = {}
    extra: dict[str, float] = {}

    # ---- U8: publish n-1 (untimed), tracked upsert of n (timed) ----------------------------------
    incoming = sum(conform(fx[f"fx_{t}_curr"], TABLES[t]).count() for t in TRACKED)
    runs, store = [], None
    for _ in range(reps):
        store = publish(spark, fx, scratch_path(spark, "bench-store"), "_prev", PREV_MONTH)
        t0 = time.perf_counter()
        tx = store.begin(CURR_MONTH)
        frames = {t: conform(fx[f"fx_{t}_curr"], TABLES[t]) for t in TRACKED}
        upsert_tables(tx, frames, CURR_MONTH, DETECTED_AT, order=None)
        tx.commit()
        runs.append(time.perf_counter() - t0)
    q["u8_tracked_upsert"] = statistics.median(runs)
    extra["u8_rows_per_sec"] = incoming / q["u8_tracked_upsert"]

    reg = Registry(spark, store.base)
    tables = reg.tables()

    # ---- K3/K4 postings over the published state -------------------------------------------------
    t0 = time.perf_counter()
    idx = build_index(spark, tables, scratch_path(spark, "bench-index"))
    extra["k34_index_build_sec"] = time.perf_counter() - t0

    # ---- queries over the published store --------------------------------------------------------
    keys = tables["estabelecimento"].select("cnpj_basico", "cnpj_ordem", "cnpj_dv")
    masked = keys.select(
        F.concat(F.substring("cnpj_basico", 1, 2), F.lit("."), F.substring("cnpj_basico", 3, 3), F.lit("."),
                 F.substring("cnpj_basico", 6, 3), F.lit("/"), "cnpj_ordem", F.lit("-"), "cnpj_dv").alias("requested")
    )
    one = keys.orderBy("cnpj_basico", "cnpj_ordem", "cnpj_dv").limit(1).collect()[0]
    single = "".join(one)
    companies = tables["empresa"].select(F.col("cnpj_basico").alias("requested"))
    log = read_change_log(store)

    plan = {
        "j1_registry_view": lambda: registry_view(tables),
        "q5_search_documents": lambda: search_documents(tables),
        "q7_search_contains": lambda: search_contains(tables, CONTAINS_Q, CONTAINS_UF, LIMIT),
        "k3_indexed_contains": lambda: indexed_contains(tables, idx, CONTAINS_Q, CONTAINS_UF, LIMIT),
        "q8_search_prefix": lambda: search_prefix(tables, PREFIX_Q, None, LIMIT),
        "k4_indexed_prefix": lambda: indexed_prefix(tables, idx, PREFIX_Q, None, LIMIT),
        "q10_search_fuzzy": lambda: search_fuzzy(tables, FUZZY_Q, None, LIMIT),
        "k4_indexed_fuzzy": lambda: indexed_fuzzy(tables, idx, FUZZY_Q, None, LIMIT),
        "j2_profiles_bulk": lambda: profiles(tables, masked),
        "j2_profile_single": lambda: profile(tables, single),
        "q4_change_history": lambda: change_history(log, companies),
        "q1_stats": lambda: stats_exact(tables),
        "t3_quota": lambda: quota(fx["events"], "user_id", "ts", "event_id", 86_400, 2),
    }
    force(plan["j1_registry_view"]())  # warm-up
    for key, build in plan.items():
        q[key] = timed(lambda b=build: force(b()), reps)

    # ---- S8: registry text → typed rows ---------------------------------------------------------
    spec = TABLES["estabelecimento"]
    path = scratch_path(spark, "bench-s8") + "/estabelecimento"
    write_registry_csv(tables["estabelecimento"], spec, path, files=cpus)
    files = list_files(path, ".csv")
    n_s8 = tables["estabelecimento"].count()
    q["s8_read_csv"] = timed(lambda: force(load_typed(spark, files, spec)), reps)
    extra["s8_rows_per_sec"] = n_s8 / q["s8_read_csv"]

    # ---- U13: one month end to end from archives (staging untimed) ------------------------------
    root = scratch_path(spark, "bench-u13")
    archives = stage_month(fx, "_curr", CURR_MONTH, root)
    t0 = time.perf_counter()
    out = run_month(spark, Store(spark, f"{root}/store"), archives, CURR_MONTH, DETECTED_AT, f"{root}/staging")
    extra["u13_run_month_sec"] = time.perf_counter() - t0
    loaded = sum(v.get("rows", 0) for v in out["tables"].values())
    extra["u13_rows_per_sec"] = loaded / extra["u13_run_month_sec"]

    result = {
        "metric": "headline_total_sec",
        "value": round(sum(q.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in q.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
        "extra": {k: round(v, 3) for k, v in extra.items()},
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
