"""Ledgers: U9 file ledger, U10 archive outcome, U11 month ledger / latest
processed, U12 reset month.  Ledgers grow with the number of files and runs,
never with data rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.routing import route_column

SUCCESS, FAILED, NO_MATCH = "SUCCESS", "FAILED", "NO_MATCH"


def is_processed(ledger: DataFrame, month: str, filename: str) -> DataFrame:
    """U9 check: SUCCESS rows of one (month, file)."""
    return ledger.where((F.col("data_month") == month) & (F.col("filename") == filename) & (F.col("status") == SUCCESS))


def append_files(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    """U9 append."""
    return ledger.unionByName(rows.select(*ledger.columns))


def archive_outcome(members: DataFrame, archive: str = "archive", member: str = "member", ok: str = "load_ok") -> DataFrame:
    """SUCCESS iff ≥1 member routed and every routed member loaded;
    nothing routed → NO_MATCH (no ledger row, not an error); a failed member → FAILED."""
    routed = route_column(member).isNotNull()
    g = members.groupBy(archive).agg(
        F.count("*").alias("members"),
        F.count_if(routed).alias("routed"),
        F.bool_and(F.when(routed, F.col(ok)).otherwise(F.lit(True))).alias("all_loaded"),
    )
    status = (
        F.when(F.col("routed") == 0, F.lit(NO_MATCH))
        .when(F.col("all_loaded"), F.lit(SUCCESS))
        .otherwise(F.lit(FAILED))
    )
    return g.select(archive, "members", "routed", status.alias("status"))


def latest_processed(month_ledger: DataFrame, seq: list[str]) -> DataFrame:
    """The last *recorded* month (by ``seq``, the run that recorded it), not
    the maximum month."""
    return month_ledger.agg(
        F.max_by("data_month", F.struct(*[F.col(c) for c in seq])).alias("latest_processed"),
        F.max("data_month").alias("max_month"),
        F.count("*").alias("ledger_rows"),
    )


def reset_month(ledger: DataFrame, month: str | None = None, month_col: F.Column | None = None) -> DataFrame:
    """Drop one month's ledger rows so the month loads again (data is kept)."""
    target = F.lit(month) if month_col is None else month_col
    return ledger.where(F.col("data_month") != target)
