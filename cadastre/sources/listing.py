"""Discovery over listing documents and manifests: S1 listing_months,
S2 latest_month, S3 listing_archives, S4 archive_urls, S5 pending_files,
S6 needs_refresh.  Listing pages are rows of a DataFrame (one per fetched
document), so discovery over many pages is an ordinary distributed job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The month-folder and archive-name patterns.
MONTH_PATTERN = r"(\d{4}-\d{2})"
ARCHIVE_PATTERN = r"([a-zA-Z0-9_\-]+\.zip)"


def listing_months(listing: DataFrame, body: str = "body") -> DataFrame:
    """Every YYYY-MM token of the documents, distinct, ascending (no range check)."""
    m = listing.select(F.explode(F.regexp_extract_all(F.col(body), F.lit(MONTH_PATTERN), 1)).alias("month"))
    return m.distinct().orderBy("month")


def latest_month(listing: DataFrame, body: str = "body") -> DataFrame:
    """Lexicographic maximum of S1 (one row; NULL when there is none)."""
    return listing_months(listing, body).agg(F.max("month").alias("latest_month"))


def archive_url(base: str, month, name) -> F.Column:
    """``base/month/name`` with exactly one slash at each joint."""
    b = base.rstrip("/")
    return F.concat(F.lit(b + "/"), F.col(month) if isinstance(month, str) else month, F.lit("/"),
                    F.col(name) if isinstance(name, str) else name)


def listing_archives(listing: DataFrame, base: str, month: str = "month", body: str = "body") -> DataFrame:
    """S3 + S4: per month listing, every ``*.zip`` name, distinct, with its URL."""
    a = listing.select(
        F.col(month).alias("month"),
        F.explode(F.regexp_extract_all(F.col(body), F.lit(ARCHIVE_PATTERN), 1)).alias("archive"),
    ).distinct()
    return a.select("month", "archive", archive_url(base, "month", "archive").alias("url")).orderBy("month", "archive")


def pending_files(listed: DataFrame, ledger: DataFrame, month: str | None = None) -> DataFrame:
    """Listed (data_month, filename) without a SUCCESS ledger row; FAILED rows do not block."""
    done = ledger.where(F.col("status") == "SUCCESS").select("data_month", "filename")
    files = listed if month is None else listed.where(F.col("data_month") == month)
    return files.join(done, ["data_month", "filename"], "left_anti")


def needs_refresh(remote: DataFrame, local: DataFrame, name: str = "name") -> DataFrame:
    """Fetch iff the local copy is missing, the remote size is unknown, or sizes differ."""
    j = remote.join(local, name, "left")
    fetch = F.col("local_size").isNull() | F.col("remote_size").isNull() | (F.col("local_size") != F.col("remote_size"))
    return j.select(name, "remote_size", "local_size", fetch.alias("needs_fetch"))
