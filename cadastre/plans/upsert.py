"""U8 tracked upsert: snapshot n + state n-1 → state n + change log n.

A load writes what changed, not what there is.  The snapshot is de-duplicated
and compared with the stored rows in one left join; new and changed rows (with
the old values) are written once, as the run's *delta*.  The change log, the
counts and the new state all come from that small table.

The state lies in buckets of the company key, one folder each.  Only buckets
that hold a new or changed row are written again (stored rows without the
delta's keys, and the delta's rows); the commit names the folders of the other
buckets as they are.  A snapshot without changes writes no state at all.
Nothing is persisted on executors: a lost one costs the recomputation of its
tasks from files.

Untracked tables fall back to U1 (insert-ignore); ``socios`` (U3) is appended,
and readers see all versions together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import BROADCAST_MAX_ROWS
from ..operators.reads import key_sketch
from ..operators.state import (
    CHANGED,
    NEW,
    REJECTED,
    change_entries,
    class_count_exprs,
    compare_incoming,
    first_by_key,
    insert_ignore,
    latest_by_key,
    rejected_rows,
)
from ..schema import CHANGE_LOG, SPARK_TYPES, TableSpec, conform
from .store import BUCKET, Store, Transaction, bucket_column, bucket_of, buckets_in, bytes_of

ORDER_COLUMNS = ["_file", "_ord"]
SKETCHES = T.StructType([T.StructField("competencia", T.StringType()), T.StructField("sketch", T.BinaryType())])


def _incomplete_key(spec: TableSpec):
    bad = None
    for k in spec.keys:
        c = F.col(k).isNull()
        bad = c if bad is None else bad | c
    return bad


def dedupe_snapshot(incoming: DataFrame, spec: TableSpec, order: list[str] | None) -> DataFrame:
    """B1 fix: first row per key by (file name, ordinal) wins; one comparison per key.

    Output: the declared columns (typed) plus ``_rid`` — 0 for every row with a
    complete key, a unique id for a row whose key is incomplete, so such rows
    are neither merged with each other nor lost (the diff marks them rejected,
    B7).  Grouping on (key, ``_rid``) leaves the snapshot hash-partitioned on
    exactly the columns the diff joins on, so the join needs no second shuffle
    of the snapshot."""
    keys = list(spec.keys)
    rid = F.when(_incomplete_key(spec), F.monotonically_increasing_id() + 1).otherwise(F.lit(0)).alias("_rid")
    typed = conform(incoming, spec).columns
    cols = [F.col(c).cast(spec.struct[c].dataType).alias(c) for c in typed]
    if order and all(c in incoming.columns for c in order):
        df = incoming.select(*cols, *order, rid)
        return first_by_key(df, keys + ["_rid"], order)
    # no order known: the smallest row by its values, so that a retry gives the same
    df = incoming.select(*cols, rid)
    return first_by_key(df, keys + ["_rid"], [c for c in typed if c not in keys], keep_order=True)


def _write_rejects(tx: Transaction, spec: TableSpec, rejects: DataFrame, rows: int | None = None) -> int:
    """Rows whose key is incomplete are kept in ``rejects/<table>`` with a
    reason instead of being compared or loaded (the reference crashed on them)."""
    cols = [c for c in spec.column_names if c in rejects.columns]
    out = rejects.select(*[F.col(c).cast("string") for c in cols], F.lit("incomplete key").alias("reason"))
    return tx.append(f"rejects/{spec.name}", out, rows=rows)


def replace_latest(prev: DataFrame, incoming: DataFrame, spec: TableSpec, order: list[str] | None) -> DataFrame:
    """U2 as a load mode: stored rows rank before this run's rows, and inside
    the run the last row by (file, ordinal) wins (``max_by``, map-side combined)."""
    cols = spec.column_names
    seq_in = [F.lit(1).alias("_run")] + ([F.col(c).alias(f"_s{i}") for i, c in enumerate(order)] if order else [])
    seq_old = [F.lit(0).alias("_run")] + (
        [F.lit(None).cast(incoming.schema[c].dataType).alias(f"_s{i}") for i, c in enumerate(order)] if order else []
    )
    both = prev.select(*cols, F.struct(*seq_old).alias("_seq")).unionByName(
        conform(incoming, spec).select(*cols).withColumn("_seq", F.struct(*seq_in)) if not order
        else incoming.select(*cols, F.struct(*seq_in).alias("_seq"))
    )
    return latest_by_key(both, list(spec.keys), ["_seq"]).select(*cols)


def tracked_upsert(
    tx: Transaction,
    spec: TableSpec,
    incoming: DataFrame,
    competencia: str,
    detected_at: str,
    order: list[str] | None = ORDER_COLUMNS,
    untracked_mode: str = "insert",
) -> dict:
    """Write state n of ``spec`` and its change-log entries into ``tx``; return the counts.

    Untracked keyed tables: ``untracked_mode="insert"`` keeps stored rows (U1,
    the reference's behaviour, B14) or ``"latest"`` lets the newest file row
    replace them (U2, replacing-merge semantics)."""
    store: Store = tx.store
    order = order if order and all(c in incoming.columns for c in order) else None
    raw = Observation(f"raw-{spec.name}-{uuid.uuid4().hex[:8]}")
    seen = [F.count(F.lit(1)).alias("rows"), *([key_sketch(list(spec.keys)).alias("sketch")] if spec.keys else [])]
    incoming = incoming.observe(raw, *seen)  # counted and sketched (Q3) on the scan that loads
    if not spec.tracked:
        if not spec.keys:  # U3: the new rows only; readers unite the versions
            n = tx.append(spec.name, conform(incoming, spec))
            return {"tabela": spec.name, "rows": store.rows(spec.name) + n, "rejected": 0, "duplicates": 0}
        prev = conform(store.read(spec.name, spec.struct), spec)
        # Code tables: a few thousand rows, a separate filter pass is cheap.
        bad = _incomplete_key(spec)
        rejected = _write_rejects(tx, spec, incoming.where(bad))
        good = incoming.where(~bad)
        inc = good if order else conform(good, spec)
        if untracked_mode == "latest":
            new_state = replace_latest(prev, inc, spec, order)
        else:
            new_state = insert_ignore(prev, inc, list(spec.keys), order).select(*spec.column_names)
        n = tx.write_table(spec.name, new_state, sort_by=list(spec.keys[:1]) or None)
        write_sketch(tx, spec, competencia, raw)
        return {"tabela": spec.name, "rows": n, "rejected": rejected}

    commits = store.commits()
    folders = [p for c in store.parts(spec.name, commits) for p in c["paths"]]
    buckets = buckets_in(folders) or buckets_for(incoming)
    snap = dedupe_snapshot(incoming, spec, order)
    prev = conform(store.read(spec.name, spec.struct, commits), spec)

    obs = Observation(f"upsert-{spec.name}-{uuid.uuid4().hex[:8]}")
    if not folders:
        counts = first_load(tx, spec, snap, raw, obs, buckets)
        write_sketch(tx, spec, competencia, raw)
        return counts
    # One pass over both inputs: the delta is written, the counts are observed.
    delta = compare_incoming(prev, snap, spec).observe(obs, *class_count_exprs()).where(F.col("_class").isin(NEW, CHANGED, REJECTED))
    staged = tx.draft(spec.name)
    delta.withColumn(BUCKET, bucket_column(spec.keys[0], buckets)).write.mode("overwrite").parquet(staged)
    delta = store.spark.read.parquet(staged)
    counts = {"tabela": spec.name, **obs.get}
    counts["kept_absent"] = store.rows(spec.name, commits) - counts["changed"] - counts["unchanged"]
    counts["duplicates"] = raw.get["rows"] - counts["incoming"]
    counts["rows"] = counts["incoming"] - counts["rejected"] + counts["kept_absent"]
    write_sketch(tx, spec, competencia, raw)
    if counts["rejected"]:
        _write_rejects(tx, spec, rejected_rows(delta, spec), rows=counts["rejected"])
    # Sorted by company inside each file (no extra exchange): a one-company
    # history skips every row group whose min/max range misses it.
    if counts["log_rows"]:
        log = change_entries(delta, spec, competencia, detected_at)
        tx.append(f"change_log/{spec.name}", log, rows=counts["log_rows"], sort_within=["cnpj_basico"])
    if counts["new"] + counts["changed"]:
        tx.delta[spec.name] = delta.where(F.col("_class") != REJECTED)
        write_touched(tx, spec, tx.delta[spec.name], counts, folders, buckets)
    return counts


def write_sketch(tx: Transaction, spec: TableSpec, competencia: str, raw: Observation) -> None:
    """Q3: the sketch of the load's keys, a few KB, beside the load."""
    row = [(competencia, bytes(raw.get["sketch"]))]
    tx.append(f"sketch/{spec.name}", tx.store.spark.createDataFrame(row, SKETCHES).coalesce(1), rows=1)


def read_sketches(store: Store, tables: tuple[str, ...] = ("empresa", "estabelecimento")) -> dict[str, DataFrame]:
    """The stored sketches of every load, by table."""
    commits = store.commits()
    return {t: store.read(f"sketch/{t}", SKETCHES, commits) for t in tables}


def first_load(tx: Transaction, spec: TableSpec, snap: DataFrame, raw: Observation, obs: Observation, buckets: int) -> dict:
    """The first state of a table: every complete row is new, nothing is compared."""
    keys = list(spec.keys)
    bad = _incomplete_key(spec)
    seen = snap.observe(obs, F.count(F.lit(1)).alias("incoming"), F.count_if(bad).alias("rejected"))
    rows = seen.where(~bad).select(*spec.column_names, bucket_column(keys[0], buckets).alias(BUCKET))
    tx.write_buckets(spec.name, rows.repartition(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(4))), keys, -1)
    seen_ = obs.get
    counts = {"tabela": spec.name, "incoming": seen_["incoming"], "new": seen_["incoming"] - seen_["rejected"], "changed": 0, "unchanged": 0,
              "kept_absent": 0, "rejected": seen_["rejected"], "log_rows": 0, "duplicates": raw.get["rows"] - seen_["incoming"]}
    counts["rows"] = counts["new"]
    tx.set_rows(spec.name, counts["rows"])
    if counts["rejected"]:
        _write_rejects(tx, spec, snap.where(bad), rows=counts["rejected"])
    if counts["new"]:
        tx.delta[spec.name] = None  # every row
    return counts


#: Bytes of the files of a table's first load for each bucket.
BUCKET_BYTES = 128 << 20


def buckets_for(rows: DataFrame) -> int:
    """Buckets of a new table, by the bytes of the files it is loaded from: four at
    least, so that small tables are few files, and as many as the load is large."""
    size = sum(bytes_of(rows.sparkSession, f) for f in rows.inputFiles())
    return max(4, -(-size // BUCKET_BYTES))


def write_touched(tx: Transaction, spec: TableSpec, delta: DataFrame, counts: dict, folders: list[str], buckets: int) -> None:
    """The state's buckets that hold a row of ``delta``, written anew; the others stay."""
    keys = list(spec.keys)
    rows = delta.select(*keys, *[F.col("n_" + c).alias(c) for c in spec.column_names if c not in keys], BUCKET)
    touched = {r[BUCKET] for r in delta.select(BUCKET).distinct().collect()}  # at most the number of buckets
    old = [p for p in folders if bucket_of(p) is None or bucket_of(p) in touched]
    changed = counts["new"] + counts["changed"]
    if old:
        small = changed <= BROADCAST_MAX_ROWS
        gone = delta.where(F.col("_class") == CHANGED).select(*keys)
        base = tx.store.spark.read.schema(spec.struct).parquet(*old)
        kept = base.join(F.broadcast(gone) if small else gone, keys, "left_anti")
        kept = kept.withColumn(BUCKET, bucket_column(keys[0], buckets))
        rows = kept.unionByName(rows.select(*kept.columns))
    # One task a bucket, or a few for a company that holds much of one.
    spread = F.pmod(F.xxhash64(*keys), F.lit(4))
    out = rows.repartition(BUCKET, spread).select(*[F.col(c).cast(SPARK_TYPES[k]).alias(c) for c, k in spec.columns], BUCKET)
    tx.write_buckets(spec.name, out, keys, counts["rows"], [p for p in folders if p not in set(old)])


def upsert_tables(
    tx: Transaction,
    frames: dict[str, DataFrame],
    competencia: str,
    detected_at: str,
    order: list[str] | None = ORDER_COLUMNS,
    untracked_mode: str = "insert",
    parallel: int = 4,
) -> dict[str, dict]:
    """U8/U1/U3 for several tables of one run; their jobs are independent, so
    they are submitted concurrently from a few driver threads."""
    from concurrent.futures import ThreadPoolExecutor

    from ..schema import TABLES

    def one(name: str) -> tuple[str, dict]:
        return name, tracked_upsert(
            tx, TABLES[name], frames[name], competencia, detected_at, order=order, untracked_mode=untracked_mode
        )

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return dict(pool.map(one, list(frames)))


def read_change_log(store: Store) -> DataFrame:
    """All committed change-log entries of every tracked table."""
    parts = [
        store.read(f"change_log/{t}", CHANGE_LOG)
        for t in ("empresa", "estabelecimento", "simples")
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


