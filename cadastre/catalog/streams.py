"""Streaming queries: T1 incremental ingest, T2 stream upsert, T3 quota (batch and stream)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import CURR_MONTH, DETECTED_AT, PREV_MONTH, Fixtures, duckdb_with
from ..plans.store import Store
from ..schema import TABLES
from ..session import SHUFFLES_GO, scratch_path, settings
from ..sources.csv import write_registry_csv
from ..streaming.ingest import ingest_stream, run_available, stream_upsert
from ..streaming.quota import quota, quota_decisions, quota_stream
from .base import register
from .ingest import files_for
from .state import U6_SQL

QUOTA_WINDOW, QUOTA_LIMIT = 86_400, 2
WATERMARK = "1 hour"
#: Bytes of the tables from which one file of a streamed month is made: each is read by one task.
STREAMED_BYTES = 4 << 20


@register(
    "t1_incremental_ingest",
    duckdb_with("fx_empresa_prev", "fx_empresa_curr")
    + "SELECT 1 AS run, CAST(count(*) AS BIGINT) AS rows FROM fx_empresa_prev "
    + "UNION ALL SELECT 2, CAST(count(*) AS BIGINT) FROM fx_empresa_curr",
)
def t1_incremental_ingest(fx: Fixtures):
    """Two availableNow runs; the second one reads only the newly landed month."""
    spec = TABLES["empresa"]
    root = scratch_path(fx.spark, "t1")
    for run, (suffix, month) in enumerate((("_prev", PREV_MONTH), ("_curr", CURR_MONTH)), start=1):
        write_registry_csv(fx.registry(suffix)["empresa"], spec, f"{root}/src/{month}", files=2)
        df = ingest_stream(fx.spark, f"{root}/src", spec).withColumn("run", F.lit(run))
        run_available(df, f"{root}/sink", f"{root}/ckpt")
    out = fx.spark.read.parquet(f"{root}/sink")
    return out.groupBy("run").agg(F.count("*").alias("rows"))


@register("t2_stream_upsert", U6_SQL)
def t2_stream_upsert(fx: Fixtures):
    """Branch files streamed month by month through the tracked upsert."""
    spec = TABLES["estabelecimento"]
    root = scratch_path(fx.spark, "t2")
    store = Store(fx.spark, f"{root}/store")
    for suffix, month in (("_prev", PREV_MONTH), ("_curr", CURR_MONTH)):
        rows = fx.registry(suffix)["estabelecimento"]
        with settings(fx.spark, SHUFFLES_GO):
            write_registry_csv(rows, spec, f"{root}/src/{month}", files=files_for(fx, rows, STREAMED_BYTES))
        stream = ingest_stream(fx.spark, f"{root}/src", spec)
        stream_upsert(stream, store, spec, DETECTED_AT, f"{root}/ckpt", "t2")
    return store.read("estabelecimento")


QUOTA_SQL = f"""
SELECT event_id, user_id, window_id, rn <= {QUOTA_LIMIT} AS allowed,
  CAST(CASE WHEN rn <= {QUOTA_LIMIT} THEN 0 ELSE {QUOTA_WINDOW} - (ep % {QUOTA_WINDOW}) END AS BIGINT) AS retry_after
FROM (
  SELECT event_id, user_id, ep, ep // {QUOTA_WINDOW} AS window_id,
    row_number() OVER (PARTITION BY user_id, ep // {QUOTA_WINDOW} ORDER BY ts, event_id) AS rn
  FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS ep FROM events))"""


@register("t3_quota", QUOTA_SQL)
def t3_quota(fx: Fixtures):
    """T3 (batch): per request, allowed or denied with retry-after; limit 2 per user per day."""
    return quota(fx["events"], "user_id", "ts", "event_id", QUOTA_WINDOW, QUOTA_LIMIT)


QUOTA_STREAM_SQL = f"""
WITH w AS (
  SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) // {QUOTA_WINDOW} AS wid, count(*) AS requests
  FROM events GROUP BY 1, 2)
SELECT user_id, make_timestamp(wid * {QUOTA_WINDOW} * 1000000) AS window_start,
  make_timestamp((wid + 1) * {QUOTA_WINDOW} * 1000000) AS window_end,
  CAST(requests AS BIGINT) AS requests, CAST(requests - {QUOTA_LIMIT} AS BIGINT) AS denied
FROM w
WHERE requests > {QUOTA_LIMIT}
  AND make_timestamp((wid + 1) * {QUOTA_WINDOW} * 1000000) <= (SELECT max(ts) FROM events) - INTERVAL '{WATERMARK}'"""


@register("t3_quota_stream", QUOTA_STREAM_SQL)
def t3_quota_stream(fx: Fixtures):
    """T3 (stream): over-quota user-days from the event log, emitted once final."""
    root = scratch_path(fx.spark, "t3")
    schema = fx["events"].schema
    events = fx.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(fx.sf_dir)
    over = quota_stream(events, "user_id", "ts", QUOTA_WINDOW, QUOTA_LIMIT, WATERMARK)
    run_available(over, f"{root}/sink", f"{root}/ckpt")
    return fx.spark.read.parquet(f"{root}/sink")


@register("t3_quota_decisions", QUOTA_SQL)
def t3_quota_decisions(fx: Fixtures):
    """T3 (stream): every request of the event log allowed or denied as it comes, from keyed state."""
    root = scratch_path(fx.spark, "t3-decisions")
    events = fx.spark.readStream.schema(fx["events"].schema).option("pathGlobFilter", "events.parquet").parquet(fx.sf_dir)
    run_available(quota_decisions(events, "user_id", "ts", "event_id", QUOTA_WINDOW, QUOTA_LIMIT, WATERMARK), f"{root}/sink", f"{root}/ckpt")
    return fx.spark.read.parquet(f"{root}/sink")
