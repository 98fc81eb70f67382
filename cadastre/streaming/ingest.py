"""T1 incremental_ingest and T2 stream_tracked_upsert (Structured Streaming).

T1: a file stream over the folder the monthly files land in; each run with
``trigger(availableNow=True)`` takes only files the checkpoint has not seen,
then stops — the "run daily, pick up only new files" loop of the reference,
with the file ledger replaced by the stream checkpoint.

T2: ``foreachBatch`` hands each micro-batch to the tracked upsert (U8), month by
month.  Each month of a batch is one commit that also marks (batch, month), and
a month whose mark is there is passed over, so a batch that is retried after a
driver or executor loss applies nothing twice.  A month older than the
published state is refused as in the batch load (B13): its rows go to
``rejects/<table>`` with the reason.  If the store has postings (K3/K4), a batch
that makes or changes documents publishes theirs in its own commit, so a
search finds a renamed company as soon as its batch is there.

The month is the file's own folder (``…/2026-09/file``); a file that is not in
such a folder is rejected too.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import sanitize
from ..schema import TableSpec
from ..session import SHUFFLES_GO, settings
from ..sources.csv import CSV_OPTIONS

#: The month folder that holds the file.
MONTH_IN_PATH = r"/(\d{4}-\d{2})/[^/]*$"
LATE, NO_MONTH = "older than the published state", "not in a month folder"


def ingest_stream(spark: SparkSession, path: str, spec: TableSpec, multi_line: bool = True) -> DataFrame:
    """Typed streaming rows of ``spec`` from registry text files under ``path``,
    with ``_file``, ``_block`` and the month folder the file came from ('' if
    none).  Quoted newlines are read whole, as in the batch load; files known to
    have none may be split with ``multi_line=False``."""
    raw = (
        spark.readStream.schema(spec.raw_struct)
        .options(**CSV_OPTIONS)
        .option("multiLine", "true" if multi_line else "false")
        .option("recursiveFileLookup", "true")
        .csv(path)
    )
    typed = sanitize(raw.select(*spec.column_names, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")), spec)
    return typed.withColumn("_month", F.regexp_extract("_file", MONTH_IN_PATH, 1))


def run_available(df: DataFrame, sink: str, checkpoint: str, extra: dict | None = None) -> None:
    """One incremental run: append everything not yet seen to ``sink`` and stop."""
    w = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    for k, v in (extra or {}).items():
        w = w.option(k, v)
    q = w.outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()


def batch_upsert(store, spec: TableSpec, detected_at: str, query_name: str, index: bool | None = None):
    """The ``foreachBatch`` function of T2 (idempotent per batch id and month).
    ``index``: write postings; by default if the store's are up with its data."""
    from ..plans.indexes import committed_index, index_changes
    from ..plans.store import remove_folders
    from ..plans.upsert import tracked_upsert

    def reject(tx, rows: DataFrame, reason: str) -> None:
        out = rows.select(*[F.col(c).cast("string") for c in spec.column_names], F.lit(reason).alias("reason"))
        tx.append(f"rejects/{spec.name}", out)

    def apply(batch: DataFrame, batch_id: int) -> None:
        marker = f"stream/{query_name}"
        commits = store.commits()
        done = {c["competencia"] for c in commits if c["item"] == marker and c["rows"] == batch_id}
        block = F.col("_block") if "_block" in batch.columns else F.lit(0)
        # the row's place in its file, as the batch reader numbers it (before any shuffle)
        rows = batch.select(*[F.col(c).cast(spec.struct[c].dataType).alias(c) for c in spec.column_names], "_file", "_month",
                            F.struct(block.alias("block"), F.monotonically_increasing_id().alias("row")).alias("_ord"))
        # Read once and kept as a table: a cached batch would fill the executors' memory, and then their disks.
        path = f"{store.base}/data/delta/batch-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        rows = store.spark.read.schema(rows.schema).parquet(path)
        try:
            # Month folders present in this batch: a handful of values.
            for month in sorted(r["_month"] for r in rows.select("_month").distinct().collect()):
                if month in done:
                    continue  # already published by an earlier attempt of this batch
                own = rows.where(F.col("_month") == month).select(*spec.column_names, "_file", "_ord")
                tx = store.begin(month)
                newest = store.latest_competencia() or ""
                if not month or month < newest:
                    reject(tx, own, LATE if month else NO_MONTH)
                else:
                    keeps = committed_index(store, store.commits()) is not None if index is None else index
                    tracked_upsert(tx, spec, own, month, detected_at)
                    if keeps:
                        index_changes(tx)
                tx.mark(marker, batch_id)
                tx.commit()
        finally:
            remove_folders(store.spark, [path])

    def apply_tidily(batch: DataFrame, batch_id: int) -> None:
        with settings(store.spark, SHUFFLES_GO):
            apply(batch, batch_id)

    return apply_tidily


def stream_upsert(stream: DataFrame, store, spec: TableSpec, detected_at: str, checkpoint: str, query_name: str, index: bool | None = None):
    """Every micro-batch goes through the tracked upsert, month by month."""
    apply = batch_upsert(store, spec, detected_at, query_name, index)
    q = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
