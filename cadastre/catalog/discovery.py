"""Discovery and ledger queries: S1-S3, S5, S6, S9, U10, U11."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures, duckdb_with
from ..operators.ledger import SUCCESS, append_files, archive_outcome, is_processed, latest_processed, reset_month
from ..schema import TABLES
from ..sources.listing import (
    ARCHIVE_PATTERN,
    MONTH_PATTERN,
    latest_month,
    listing_archives,
    listing_months,
    needs_refresh,
    pending_files,
)
from ..sources.routing import route_files
from .base import register

BASE_URL = "https://mirror.invalid/dav/"


@register(
    "s1_listing_months",
    duckdb_with("fx_listing")
    + f"SELECT DISTINCT unnest(regexp_extract_all(body, '{MONTH_PATTERN}', 1)) AS month FROM fx_listing",
)
def s1_listing_months(fx: Fixtures):
    """Month folders named in the listing pages."""
    return listing_months(fx["fx_listing"])


@register(
    "s2_latest_month",
    duckdb_with("fx_listing")
    + f"SELECT max(m) AS latest_month FROM (SELECT unnest(regexp_extract_all(body, '{MONTH_PATTERN}', 1)) AS m FROM fx_listing)",
)
def s2_latest_month(fx: Fixtures):
    """The newest month folder."""
    return latest_month(fx["fx_listing"])


# Per-month listing documents: each href of the pages, filed under its month folder.
MONTH_DOCS_SQL = """
SELECT regexp_extract(h, '/dav/([0-9][0-9][0-9][0-9]-[0-9][0-9])/', 1) AS month, h AS body
FROM (SELECT explode(regexp_extract_all(body, '<d:href>([^<]*)</d:href>', 1)) AS h FROM {fx_listing})"""


@register(
    "s3_listing_archives",
    duckdb_with("fx_listing")
    + f"""
SELECT DISTINCT month, archive, '{BASE_URL.rstrip('/')}/' || month || '/' || archive AS url FROM (
  SELECT month, unnest(regexp_extract_all(body, '{ARCHIVE_PATTERN}', 1)) AS archive FROM (
    SELECT regexp_extract(h, '/dav/([0-9][0-9][0-9][0-9]-[0-9][0-9])/', 1) AS month, h AS body
    FROM (SELECT unnest(regexp_extract_all(body, '<d:href>([^<]*)</d:href>', 1)) AS h FROM fx_listing)))""",
)
def s3_listing_archives(fx: Fixtures):
    """Archive names per month folder and their URLs."""
    return listing_archives(fx.sql(MONTH_DOCS_SQL), BASE_URL)


@register(
    "s5_pending_files",
    duckdb_with("fx_files", "fx_ledger")
    + """
SELECT f.data_month, f.filename FROM fx_files f WHERE NOT EXISTS (
  SELECT 1 FROM fx_ledger l WHERE l.status = 'SUCCESS' AND l.data_month = f.data_month AND l.filename = f.filename)""",
)
def s5_pending_files(fx: Fixtures):
    """Listed files of every month with no SUCCESS ledger row."""
    return pending_files(fx["fx_files"], fx["fx_ledger"])


REMOTE_SQL = """
SELECT concat(date_format(o_orderdate,'yyyy-MM'), '/Estabelecimentos', CAST(o_orderkey % 10 AS STRING), '.zip') AS name,
  CASE WHEN count(*) % 7 = 0 THEN NULL ELSE count(*) * 1000 END AS remote_size
FROM {orders} GROUP BY 1"""

LOCAL_SQL = """
SELECT concat(date_format(o_orderdate,'yyyy-MM'), '/Estabelecimentos', CAST(o_orderkey % 10 AS STRING), '.zip') AS name,
  count(*) * 1000 + CASE WHEN sum(o_custkey) % 5 = 0 THEN 1 ELSE 0 END AS local_size
FROM {orders} WHERE o_orderkey % 10 < 6 GROUP BY 1"""


def _duck(sql: str) -> str:
    return sql.replace("{orders}", "orders").replace("date_format(o_orderdate,'yyyy-MM')", "strftime(o_orderdate,'%Y-%m')")


@register(
    "s6_needs_refresh",
    f"""
WITH remote AS ({_duck(REMOTE_SQL)}), local AS ({_duck(LOCAL_SQL)})
SELECT r.name, CAST(r.remote_size AS BIGINT) AS remote_size, CAST(l.local_size AS BIGINT) AS local_size,
  (l.local_size IS NULL OR r.remote_size IS NULL OR l.local_size <> r.remote_size) AS needs_fetch
FROM remote r LEFT JOIN local l ON r.name = l.name""",
)
def s6_needs_refresh(fx: Fixtures):
    """Remote manifest vs local copies → files to fetch."""
    remote = fx.sql(REMOTE_SQL).select("name", F.col("remote_size").cast("bigint"))
    local = fx.sql(LOCAL_SQL).select("name", F.col("local_size").cast("bigint"))
    return needs_refresh(remote, local)


def _d_route(col: str) -> str:
    whens = []
    for spec in TABLES.values():
        for m in spec.markers:
            whens.append(f"WHEN contains(upper(split_part({col}, '/', -1)), '{m}') THEN '{spec.name}'")
    return "CASE " + " ".join(whens) + " END"


@register(
    "s9_route_files",
    duckdb_with("fx_members") + f"SELECT p_partkey, member, archive, {_d_route('member')} AS \"table\" FROM fx_members",
)
def s9_route_files(fx: Fixtures):
    """Archive members routed to their table (NULL = ignored)."""
    return route_files(fx["fx_members"].select("p_partkey", "member", "archive"), "member")


# Members of an archive lie in folders whose names hold a marker, too; only the base name routes.
FOLDERS_SQL = """
SELECT concat(CASE p_partkey % 3 WHEN 0 THEN 'EMPRESAS/SOCIOS/' WHEN 1 THEN 'dados/' ELSE '' END, member) AS member, archive, load_ok
FROM {fx_members}"""


@register(
    "u10_archive_outcome",
    duckdb_with("fx_members").rstrip()
    + f""", inside AS ({FOLDERS_SQL.replace("{fx_members}", "fx_members")})
SELECT archive, CAST(count(*) AS BIGINT) AS members, CAST(count_if(r IS NOT NULL) AS BIGINT) AS routed,
  CASE WHEN count_if(r IS NOT NULL) = 0 THEN 'NO_MATCH'
       WHEN bool_and(CASE WHEN r IS NOT NULL THEN load_ok ELSE TRUE END) THEN 'SUCCESS' ELSE 'FAILED' END AS status
FROM (SELECT archive, load_ok, {_d_route('member')} AS r FROM inside) GROUP BY archive""",
)
def u10_archive_outcome(fx: Fixtures):
    """Ledger outcome of each archive from its members' routing and load results."""
    return archive_outcome(fx.sql(FOLDERS_SQL))


@register(
    "u11_latest_processed",
    duckdb_with("fx_ledger")
    + """
SELECT arg_max(data_month, filename || '|' || data_month) AS latest_processed, max(data_month) AS max_month,
  CAST(count(*) AS BIGINT) AS ledger_rows
FROM fx_ledger WHERE status = 'SUCCESS' AND data_month <> (SELECT max(data_month) FROM fx_ledger)
  AND NOT (filename = 'Estabelecimentos4.zip' AND data_month > '1996')""",
)
def u11_latest_processed(fx: Fixtures):
    """Month ledger in record order (file, then month) after the newest
    month is reset; the last file was not recorded after 1996, so the latest
    processed month is not the largest one."""
    ledger = fx["fx_ledger"]
    newest = ledger.select(F.max("data_month")).scalar()
    after = reset_month(ledger, month_col=newest).where(F.col("status") == "SUCCESS")
    after = after.where(~((F.col("filename") == "Estabelecimentos4.zip") & (F.col("data_month") > "1996")))
    return latest_processed(after, ["filename", "data_month"])


CHECKED = ("1995-03", "Estabelecimentos4.zip")


@register(
    "u9_file_ledger",
    duckdb_with("fx_files", "fx_ledger").rstrip()
    + f""", after AS (
  SELECT * FROM fx_ledger UNION ALL
  SELECT data_month, filename, 'SUCCESS' FROM fx_files f WHERE (data_month, filename) NOT IN (SELECT (data_month, filename) FROM fx_ledger))
SELECT data_month, status, CAST(count(*) AS BIGINT) AS rows FROM after GROUP BY 1, 2
UNION ALL
SELECT '{CHECKED[0]}', 'processed', CAST(count(*) AS BIGINT) FROM after
WHERE data_month = '{CHECKED[0]}' AND filename = '{CHECKED[1]}' AND status = 'SUCCESS'""",
)
def u9_file_ledger(fx: Fixtures):
    """Files without a ledger row appended as loaded; rows per month and
    status, and the check of one file."""
    ledger = fx["fx_ledger"]
    fresh = fx["fx_files"].join(ledger.select("data_month", "filename"), ["data_month", "filename"], "left_anti")
    after = append_files(ledger, fresh.withColumn("status", F.lit(SUCCESS)))
    counts = after.groupBy("data_month", "status").agg(F.count("*").alias("rows"))
    one = is_processed(after, *CHECKED).agg(F.count("*").alias("rows"))
    return counts.unionByName(one.select(F.lit(CHECKED[0]).alias("data_month"), F.lit("processed").alias("status"), "rows"))
