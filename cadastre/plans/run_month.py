"""U13 run_month: one monthly load end to end, archive by archive.

S5 pending archives → S7 expand (one archive per task) → S9 route members →
S8/S10/S11 typed read per table (all files of a table in one scan) → U8
tracked upsert / U1 insert-ignore / U3 append → U10 archive outcome → U9 file
ledger → U11 month ledger → postings of new and changed documents (K3/K4) → one
commit (U7) → search-document export (K5), if the documents changed.

An archive is loaded whole or not at all.  One that cannot be expanded, or one of whose
routed members does not load, is recorded as FAILED and nothing of it is
published; the month's other archives are published and recorded as
SUCCESS with the same commit, and the month itself (U11) only once no archive
fails.  The next run of the month takes up what is not recorded as SUCCESS.

A member loads if reading it to its end gives no fault and some row has the
table's key (or it has no rows): a page of HTML under a table's name, or another
layout, has none.  This is observed on the load's own scan.  If a member fails, the
run starts anew without its archive; nothing of the first attempt is visible.
Driver-side work is limited to the member list (metadata: one row per file).
What was expanded is deleted when the run has ended, as in the reference; a run that
fails leaves it.  The export is gzip-compressed JSON lines.
"""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import FAILED, NO_MATCH, SUCCESS, append_files, archive_outcome
from ..operators.reads import search_documents
from ..schema import FILE_LEDGER, MONTH_LEDGER, TABLES, TableSpec
from ..session import SHUFFLES_GO, settings
from ..sources.archives import expand_archives, stem_of
from ..sources.csv import load_typed
from ..sources.listing import pending_files
from ..sources.routing import base_name, route_column
from .indexes import index_changes
from .sinks import export_index
from .store import Store, remove_folders
from .upsert import ORDER_COLUMNS, upsert_tables


#: Members of up to so many bytes are expanded with gzip: each is read by one task.
COMPRESSED_BYTES = 256 << 20


class StaleMonthError(ValueError):
    """Loading a month older than the published state."""


def run_month(
    spark: SparkSession,
    store: Store,
    archives: list[str],
    month: str,
    detected_at: str,
    staging_dir: str,
    force: bool = False,
    multi_line: bool | str = "auto",
    parallel_tables: int = 4,
    nulls: str = "null",
    untracked_mode: str = "insert",
    index: bool = True,
    export: bool = True,
) -> dict:
    """Load ``archives`` (paths of one month's zip files) into ``store``.

    ``nulls="zero"`` types fields in the columnar-backend mode (S12: 0 / 0.00 /
    '' instead of NULL); ``untracked_mode="latest"`` makes code tables take
    the newest row per key (U2) instead of keeping the stored one (U1).  The
    summary has, besides each table's counts (rejected and duplicate keys, too),
    the archives that failed and why, those in which no member belongs to a
    table, and the export's path."""
    with settings(spark, SHUFFLES_GO):
        current = store.latest_competencia()
        if current is not None and month < current and not force:
            raise StaleMonthError(f"state is at {current}; refusing {month} without force=True")
        processed_at = _dt.datetime.fromisoformat(detected_at)
        ledger = store.read("file_ledger", FILE_LEDGER)

        listed = spark.createDataFrame(
            [(month, p.rsplit("/", 1)[-1], p) for p in archives], "data_month string, filename string, path string"
        )
        pending = pending_files(listed, ledger, month).select("path", "filename")
        target = f"{staging_dir.rstrip('/')}/{month}"
        found = expand_archives(pending.withColumnRenamed("path", "archive"), target, errors=True, compress=COMPRESSED_BYTES)
        members = found.withColumn("table", route_column("member")).collect()
        failed: dict[str, str] = {m["archive"]: m["error"] for m in members if m["error"] is not None}

        while True:
            good = [m for m in members if m["archive"] not in failed]
            tx = store.begin(month)
            # Tables are independent: their jobs are submitted concurrently (Spark runs
            # jobs from several driver threads side by side), so the small code tables
            # do not wait behind the big ones.
            paths = {n: [m["path"] for m in good if m["table"] == n] for n in TABLES}
            frames, seen = {}, {}
            for n in (n for n in TABLES if paths[n]):
                seen[n] = Observation(f"files-{n}-{uuid.uuid4().hex[:8]}")
                frames[n] = watched(load_typed(spark, paths[n], TABLES[n], multi_line, nulls), TABLES[n], seen[n])
            try:
                tables = upsert_tables(
                    tx, frames, month, detected_at, order=ORDER_COLUMNS, untracked_mode=untracked_mode, parallel=parallel_tables)
                bad = {f: "no row has the table's key" for o in seen.values() for f in without_key(o.get)}
            except Exception:
                bad = unreadable(spark, good, multi_line)
                if not bad:
                    raise  # no member is at fault
            bad = {m["archive"]: f"{m['member']}: {bad[plain_path(m['path'])]}" for m in good if plain_path(m["path"]) in bad}
            if not bad:
                break
            failed.update(bad)

        summary: dict = {"month": month, "version": tx.version, "tables": tables, "archives": len({m["archive"] for m in members}),
                         "failed": {a.rsplit("/", 1)[-1]: why for a, why in sorted(failed.items())}, "no_match": []}
        # U10 from what was loaded; an archive that could not be expanded has no members to route.
        outcome_rows = [(m["archive"], m["member"], m["archive"] not in failed) for m in members if m["member"] is not None]
        outcomes = [(a, FAILED) for a in failed]
        if outcome_rows:
            outcome = archive_outcome(spark.createDataFrame(outcome_rows, "archive string, member string, load_ok boolean"))
            outcomes += [(r["archive"], r["status"]) for r in outcome.collect() if r["archive"] not in failed]
        summary["no_match"] = sorted(a.rsplit("/", 1)[-1] for a, status in outcomes if status == NO_MATCH)
        done = [(a, status) for a, status in outcomes if status in (SUCCESS, FAILED)]
        if done:
            rows = spark.createDataFrame(done, "archive string, status string").select(
                F.lit(month).alias("data_month"), base_name("archive").alias("filename"), "status", F.lit(processed_at).cast("timestamp_ntz").alias("processed_at"))
            # Rows are added to the ledger, never written again.
            tx.append("file_ledger", append_files(spark.createDataFrame([], FILE_LEDGER), rows))
        if not failed:
            # The month is recorded even when nothing was pending (rows may repeat).
            tx.append("month_ledger", spark.createDataFrame([(month, processed_at, tx.version)], MONTH_LEDGER))
        summary["indexed"] = index_changes(tx) if index else 0
        tx.commit(processed_at)
        # K5: the documents as they are now, for an outside search engine; only if they changed.
        if export and tx.delta.keys() & {"empresa", "estabelecimento"}:
            commits = store.commits()
            now = {t: store.read(t, TABLES[t].struct, commits) for t in ("empresa", "estabelecimento")}
            summary["export"] = f"{store.base}/export/v={tx.tag}"
            export_index(search_documents(now, ordered=False), summary["export"], compression="gzip")
        remove_folders(spark, [f"{target}/{stem}" for stem in sorted({stem_of(m["archive"]) for m in members}) if stem])  # what was expanded is loaded, or will be anew
        return summary


def plain_path(path: str) -> str:
    """A file's path without scheme and leading slashes, as files are compared."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:", "", unquote(path)).lstrip("/")


def watched(rows: DataFrame, spec: TableSpec, seen: Observation) -> DataFrame:
    """Observe, on the scan that loads them, the files with rows and those of them
    in which some row has the table's key (one name a file)."""
    first = (spec.keys or spec.column_names)[0]
    key = F.col(first).rlike("^[0-9A-Za-z]{8}$") if first == "cnpj_basico" else F.col(first).isNotNull()
    return rows.observe(seen, F.collect_set("_file").alias("files"), F.collect_set(F.when(key, F.col("_file"))).alias("keyed"))


def without_key(seen: dict) -> set[str]:
    return {plain_path(f) for f in set(seen["files"] or []) - set(seen["keyed"] or [])}


def unreadable(spark: SparkSession, members: list, multi_line: bool | str) -> dict[str, str]:
    """Members that cannot be read to their end, one small job each; asked only
    after a load has failed."""
    bad = {}
    for m in (m for m in members if m["table"]):
        try:
            load_typed(spark, [m["path"]], TABLES[m["table"]], multi_line).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - the reason goes to the summary
            bad[plain_path(m["path"])] = str(e).splitlines()[0]
    return bad


def table_counts(store: Store, tables: list[str]) -> DataFrame:
    """Rows per published table and change-log rows per tracked table."""
    from ..schema import CHANGE_LOG

    parts = []
    for t in tables:
        parts.append(store.read(t, TABLES[t].struct).select(F.lit(t).alias("tabela"), F.lit(1).alias("_r"), F.lit(0).alias("_l")))
        if TABLES[t].tracked:
            log = store.read(f"change_log/{t}", CHANGE_LOG)
            parts.append(log.select(F.lit(t).alias("tabela"), F.lit(0).alias("_r"), F.lit(1).alias("_l")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    # One tagged union and one grouped count: no joins.
    return u.groupBy("tabela").agg(F.sum("_r").cast("bigint").alias("rows"), F.sum("_l").cast("bigint").alias("log_rows"))
