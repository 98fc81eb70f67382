"""Listing, manifest and ledger rules."""

from cadastre.operators.ledger import archive_outcome, latest_processed, reset_month
from cadastre.sources.listing import latest_month, listing_archives, listing_months, needs_refresh, pending_files


def test_listing_months_no_range_check(spark):
    df = spark.createDataFrame([("<a>2025-12/</a> <a>2026-99/</a> 2026-01 2025-12",)], "body string")
    assert [r["month"] for r in listing_months(df).collect()] == ["2025-12", "2026-01", "2026-99"]
    assert latest_month(df).collect()[0]["latest_month"] == "2026-99"
    empty = spark.createDataFrame([("no months here",)], "body string")
    assert latest_month(empty).collect()[0]["latest_month"] is None


def test_listing_archives_and_urls(spark):
    df = spark.createDataFrame([("2026-09", 'href="Empresas0.zip" href="Empresas0.zip" x-y_z.zip a.txt')], "month string, body string")
    rows = listing_archives(df, "https://mirror.invalid/dav/").collect()
    assert [(r["archive"], r["url"]) for r in rows] == [
        ("Empresas0.zip", "https://mirror.invalid/dav/2026-09/Empresas0.zip"),
        ("x-y_z.zip", "https://mirror.invalid/dav/2026-09/x-y_z.zip"),
    ]


def test_pending_ignores_failed(spark):
    listed = spark.createDataFrame([("2026-08", "A.zip"), ("2026-08", "B.zip"), ("2026-08", "C.zip")], "data_month string, filename string")
    ledger = spark.createDataFrame(
        [("2026-08", "A.zip", "SUCCESS"), ("2026-08", "B.zip", "FAILED"), ("2026-07", "C.zip", "SUCCESS")],
        "data_month string, filename string, status string",
    )
    assert sorted(r["filename"] for r in pending_files(listed, ledger, "2026-08").collect()) == ["B.zip", "C.zip"]


def test_needs_refresh(spark):
    remote = spark.createDataFrame([("a", 10), ("b", None), ("c", 5), ("d", 7)], "name string, remote_size bigint")
    local = spark.createDataFrame([("a", 10), ("b", 3), ("c", 6)], "name string, local_size bigint")
    got = {r["name"]: r["needs_fetch"] for r in needs_refresh(remote, local).collect()}
    assert got == {"a": False, "b": True, "c": True, "d": True}


def test_archive_outcome(spark):
    members = spark.createDataFrame(
        [
            ("docs.zip", "LEIAME.TXT", True),
            ("ok.zip", "K.EMPRECSV", True),
            ("ok.zip", "LEIAME.TXT", False),  # unrouted members do not count
            ("bad.zip", "K.SOCIOCSV", False),
            ("folder.zip", "EMPRESAS/LEIAME.TXT", True),  # a folder's name does not route
        ],
        "archive string, member string, load_ok boolean",
    )
    got = {r["archive"]: r["status"] for r in archive_outcome(members).collect()}
    assert got == {"docs.zip": "NO_MATCH", "ok.zip": "SUCCESS", "bad.zip": "FAILED", "folder.zip": "NO_MATCH"}


def test_latest_processed_is_last_recorded(spark):
    ledger = spark.createDataFrame([("2026-09", 1), ("2026-03", 2), ("2026-03", 3)], "data_month string, seq int")
    r = latest_processed(ledger, ["seq"]).collect()[0]
    assert r["latest_processed"] == "2026-03" and r["max_month"] == "2026-09"
    r2 = latest_processed(reset_month(ledger, "2026-03"), ["seq"]).collect()[0]
    assert r2["latest_processed"] == "2026-09" and r2["ledger_rows"] == 1
