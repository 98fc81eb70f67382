"""T3 fixed-window quota, re-aimed at request logs.

Rule: per key, calendar-aligned windows ``id = floor(epoch / w)``; the n-th
request of a window (by time, then id) is allowed iff n <= limit; a denied
request may retry after ``w - epoch mod w`` seconds.

Batch form without a hot-group funnel: a key may own a third of all
requests, so ranking a whole (key, window) group in one task is avoided.
The group is split into ``salt`` buckets; the global first ``limit`` rows
of a group are among the per-bucket first ``limit`` rows, so ranking runs
per bucket and then once more over at most ``salt × limit`` candidates per
group.  A repeated event is one more request: equal ones are counted first,
combined on the map side, and given out again at the end.

Stream form of the decisions: state is kept by window and slot, a hash of the
key: of each of its keys the number of requests allowed so far, so that Python
is called once for many keys.  Each request is answered in the micro-batch it comes
with, those of one batch by time, then id.  Of a batch no more rows of a key than the
limit are held; what is behind them is denied as it is read.  State goes when the watermark
passes the window's end, and requests later than that are dropped.

Stream form of the counts: watermark + tumbling ``window`` counts, append mode, emitting
the over-quota (key, window) pairs once a window can no longer change; rows
later than the watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_seconds(ts: str) -> F.Column:
    """Whole seconds since the epoch of a timestamp (NTZ or session-zone)."""
    return F.expr(f"timestampdiff(SECOND, {EPOCH_NTZ}, CAST({ts} AS TIMESTAMP_NTZ))")


def quota(
    events: DataFrame,
    key: str,
    ts: str,
    order_id: str,
    window_s: int,
    limit: int,
    salt: int = 32,
) -> DataFrame:
    """Per event: window id, allowed flag and retry-after seconds (0 when allowed)."""
    row = ["_id", "_key", "_ts"]
    # Equal requests are one row with their number before anything is gathered by key.
    each = events.select(F.col(order_id).alias("_id"), F.col(key).alias("_key"), F.col(ts).alias("_ts")).groupBy(*row).agg(F.count("*").alias("_n"))
    ep = epoch_seconds("_ts")
    base = each.select(*row, "_n", F.floor(ep / window_s).cast("bigint").alias("window_id"), ep.alias("_epoch"))
    order = [F.col("_ts"), F.col("_id")]

    def before(*group: str) -> Column:
        """Requests of the group that come before a row's."""
        return F.sum("_n").over(Window.partitionBy(*group).orderBy(*order)) - F.col("_n")

    bucket = F.pmod(F.xxhash64("_id"), F.lit(salt))
    stage1 = base.withColumn("_salt", bucket).withColumn("_b", before("_key", "window_id", "_salt")).where(F.col("_b") < limit)
    stage2 = stage1.withColumn("_b", before("_key", "window_id")).where(F.col("_b") < limit)
    allowed = stage2.select(*row, F.least("_n", F.lit(limit) - F.col("_b")).alias("_ok"))
    j = base.join(allowed, row, "left").withColumn("_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    ok = F.col("_i") <= F.coalesce(F.col("_ok"), F.lit(0))
    return j.select(
        F.col("_id").alias(order_id),
        F.col("_key").alias(key),
        "window_id",
        ok.alias("allowed"),
        F.when(ok, F.lit(0)).otherwise(F.lit(window_s) - F.pmod(F.col("_epoch"), F.lit(window_s))).cast("bigint").alias(
            "retry_after"
        ),
    )


def quota_stream(events: DataFrame, key: str, ts: str, window_s: int, limit: int, watermark: str) -> DataFrame:
    """Streaming T3: over-quota (key, window) pairs, final once the watermark passes."""
    t = F.col(ts).cast("timestamp")
    w = f"{window_s} seconds"
    counted = (
        events.select(F.col(key), t.alias("_t"))
        .withWatermark("_t", watermark)
        .groupBy(F.col(key), F.window("_t", w))
        .agg(F.count("*").alias("requests"))
    )
    return counted.where(F.col("requests") > limit).select(
        F.col(key),
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "requests",
        (F.col("requests") - limit).alias("denied"),
    )


def quota_decisions(
    events: DataFrame, key: str, ts: str, order_id: str, window_s: int, limit: int, watermark: str, slots: int = 64
) -> DataFrame:
    """Streaming T3 for each request: window id, allowed flag and retry-after
    seconds (0 when allowed), emitted in the request's own micro-batch.  The
    keys of a window share ``slots`` groups; more of them make smaller states."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    out = T.StructType([T.StructField(order_id, events.schema[order_id].dataType), T.StructField(key, events.schema[key].dataType),
                        *T.StructType.fromDDL("window_id bigint, allowed boolean, retry_after bigint")])

    def decide(group: tuple, chunks: Iterator[Any], state: GroupState) -> Iterator[Any]:
        import pandas as pd

        if state.hasTimedOut:
            state.remove()
            return
        window, nameless = group[0], group[1] < 0  # requests without a key have a group of their own
        before = dict(zip(*state.get, strict=True)) if state.exists else {}
        used = {0: n for n in before.values()} if nameless else before

        def keys(rows):
            return pd.Series(0, index=rows.index) if nameless else rows["_key"]

        def answer(rows, ok: bool):
            wait = 0 if ok else window_s - rows["_epoch"] % window_s
            return pd.DataFrame({order_id: rows["_id"], key: rows["_key"], "window_id": rows["_window"], "allowed": ok, "retry_after": wait})

        first = None  # each key's earliest rows that may still be allowed
        for rows in chunks:
            held = rows if first is None else pd.concat([first, rows])
            held = held.sort_values(["_ts", "_id"], kind="stable", ignore_index=True)
            name = keys(held)
            left = limit - name.map(used).fillna(0) if used else limit
            may = held.groupby(name, sort=False).cumcount() < left
            first = held[may]
            if len(first) < len(held):
                yield answer(held[~may], False)
        if first is not None and len(first):
            yield answer(first, True)
            now = keys(first).value_counts(sort=False)
            for name, n in zip(now.index.tolist(), now.tolist(), strict=True):  # as Python's own values, for the state
                used[name] = used.get(name, 0) + n
        state.update(([None], [used.get(0, 0)]) if nameless else ([*used], [*used.values()]))
        if not pd.isna(window):
            end = 1000 * (int(window) + 1) * window_s
            state.setTimeoutTimestamp(max(end, int(state.getCurrentWatermarkMs()) + 1))

    t = F.col(ts).cast("timestamp")
    epoch = epoch_seconds(ts)
    slot = F.when(F.col(key).isNull(), -1).otherwise(F.pmod(F.xxhash64(key), F.lit(slots)))
    rows = events.select(t.alias("_ts"), F.col(order_id).alias("_id"), F.col(key).alias("_key"), epoch.cast("bigint").alias("_epoch"),
                         F.floor(epoch / window_s).cast("bigint").alias("_window"), slot.cast("int").alias("_slot")).withWatermark("_ts", watermark)
    held = T.StructType([T.StructField("keys", T.ArrayType(events.schema[key].dataType)), *T.StructType.fromDDL("used array<int>")])
    return rows.groupBy("_window", "_slot").applyInPandasWithState(decide, out, held, "append", GroupStateTimeout.EventTimeTimeout)
