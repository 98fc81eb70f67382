"""Column-function queries: S11-S13 (and the load quality report), F1/F2, F10, F11, F12."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Fixtures, duckdb_with
from ..functions import (
    bulk_tsv_value,
    canonical_text,
    client_key,
    cnpj_clean,
    cnpj_full,
    cnpj_is_valid,
    cnpj_parts,
    prefix_terms,
    sanitize_value,
    zero_value,
)
from ..functions.search_terms import OPERATOR_CHARACTERS
from ..functions.values import WHITESPACE
from ..operators.quality import quality_report
from ..oracle_sql import d_bulk, d_int, d_num, d_text, d_trim
from ..schema import INTEGER, NUMERIC, TEXT
from .base import register

RAW_FIELDS = [("num_txt", NUMERIC), ("int_txt", INTEGER), ("txt", TEXT)]
_OUT = {"num_txt": "num", "int_txt": "int", "txt": "txt"}


@register(
    "s11_sanitize_null",
    duckdb_with("fx_raw")
    + "SELECT c_custkey, "
    + ", ".join(
        f"{ {NUMERIC: d_num, INTEGER: d_int, TEXT: d_text}[k](c)} AS {_OUT[c]}" for c, k in RAW_FIELDS
    )
    + " FROM fx_raw",
)
def s11_sanitize_null(fx: Fixtures):
    """Dirty text → typed values, blank or unparsable → NULL."""
    raw = fx["fx_raw"]
    return raw.select("c_custkey", *[sanitize_value(c, k).alias(_OUT[c]) for c, k in RAW_FIELDS])


def _d_zero(c, k):
    if k == NUMERIC:
        return f"coalesce({d_num(c)}, CAST(0 AS DECIMAL(15,2)))"
    if k == INTEGER:
        return f"coalesce({d_int(c)}, CAST(0 AS BIGINT))"
    return f"coalesce({d_text(c)}, '')"


@register(
    "s12_sanitize_zero",
    duckdb_with("fx_raw")
    + "SELECT c_custkey, "
    + ", ".join(f"{_d_zero(c, k)} AS {_OUT[c]}" for c, k in RAW_FIELDS)
    + " FROM fx_raw",
)
def s12_sanitize_zero(fx: Fixtures):
    """The columnar-backend mode, NULL → 0 / 0.00 / ''."""
    raw = fx["fx_raw"]
    return raw.select("c_custkey", *[zero_value(c, k).alias(_OUT[c]) for c, k in RAW_FIELDS])


def _d_canon(c, k):
    v = {NUMERIC: d_num, INTEGER: d_int, TEXT: d_text}[k](c)
    return f"coalesce(CAST({v} AS VARCHAR), '')"


@register(
    "s13_canonical",
    duckdb_with("fx_raw")
    + "SELECT c_custkey, "
    + ", ".join(f"{_d_canon(c, k)} AS {_OUT[c]}" for c, k in RAW_FIELDS)
    + " FROM fx_raw",
)
def s13_canonical(fx: Fixtures):
    """Comparison text form of each raw field."""
    raw = fx["fx_raw"]
    return raw.select("c_custkey", *[canonical_text(c, k).alias(_OUT[c]) for c, k in RAW_FIELDS])


@register(
    "f1_cnpj_clean",
    duckdb_with("fx_raw")
    + """
SELECT c_custkey, cnpj_txt, cnpj_clean, length(cnpj_clean) = 14 AS is_valid,
  substr(cnpj_clean, 1, 8) AS cnpj_basico, substr(cnpj_clean, 9, 4) AS cnpj_ordem,
  substr(cnpj_clean, 13, 2) AS cnpj_dv,
  substr(cnpj_clean, 1, 8) || substr(cnpj_clean, 9, 4) || substr(cnpj_clean, 13, 2) AS cnpj_full
FROM (SELECT c_custkey, cnpj_txt, regexp_replace(cnpj_txt, '[^a-zA-Z0-9]', '', 'g') AS cnpj_clean FROM fx_raw)
""",
)
def f1_cnpj_clean(fx: Fixtures):
    """masked keys cleaned, validated, split and re-joined."""
    raw = fx["fx_raw"].select("c_custkey", "cnpj_txt", cnpj_clean("cnpj_txt").alias("cnpj_clean"))
    parts = cnpj_parts("cnpj_clean")
    return raw.select(
        "c_custkey",
        "cnpj_txt",
        "cnpj_clean",
        cnpj_is_valid("cnpj_clean").alias("is_valid"),
        *[v.alias(k) for k, v in parts.items()],
    ).withColumn("cnpj_full", cnpj_full())


# Queries built from every part name: plain, with a short word, with operator
# characters, padded brand, and a cut-off name.
PART_QUERIES_SQL = """
SELECT p_partkey,
  CASE p_partkey % 5
    WHEN 0 THEN p_name
    WHEN 1 THEN concat(p_name, ' ab')
    WHEN 2 THEN concat('+', replace(p_name, ' ', ' -'), '*')
    WHEN 3 THEN concat('  ', p_brand, '  ')
    ELSE substr(p_name, 1, 4) END AS q
FROM {part}"""


def _d_prefix_terms(q: str) -> str:
    ws_class = "[" + WHITESPACE.replace("\\", "\\\\") + "]+"
    words = f"list_filter(string_split_regex({d_trim(q)}, '{ws_class}'), lambda w: w <> '')"
    ops = "[" + OPERATOR_CHARACTERS.replace("-", "\\-") + "]"
    stripped = f"list_transform({words}, lambda w: regexp_replace(w, '{ops}', '', 'g'))"
    ok = f"(len({stripped}) > 0 AND len(list_filter({stripped}, lambda w: length(w) < 3)) = 0)"
    joined = f"array_to_string(list_transform({stripped}, lambda w: '+' || w || '*'), ' ')"
    return f"CASE WHEN {ok} THEN {joined} END"


@register(
    "f10_prefix_terms",
    "SELECT p_partkey, q, " + _d_prefix_terms("q") + " AS terms FROM (" + PART_QUERIES_SQL.replace("{part}", "part") + ")",
)
def f10_prefix_terms(fx: Fixtures):
    """F10 over a table of queries: boolean-mode prefix terms or NULL (rejected)."""
    qs = fx.sql(PART_QUERIES_SQL)
    return qs.select("p_partkey", "q", prefix_terms("q").alias("terms"))


@register(
    "f11_bulk_tsv",
    duckdb_with("fx_raw")
    + "SELECT c_custkey, "
    + ", ".join(f"{d_bulk(c, k)} AS {_OUT[c]}" for c, k in RAW_FIELDS)
    + ", "
    + " || chr(9) || ".join(d_bulk(c, k) for c, k in RAW_FIELDS)
    + " AS line FROM fx_raw",
)
def f11_bulk_tsv(fx: Fixtures):
    """Bulk-load text value per field and the tab-separated line."""
    raw = fx["fx_raw"]
    vals = [bulk_tsv_value(c, k) for c, k in RAW_FIELDS]
    return raw.select(
        "c_custkey", *[v.alias(_OUT[c]) for v, (c, _) in zip(vals, RAW_FIELDS)], F.concat_ws("\t", *vals).alias("line")
    )


# Synthetic request headers derived from every event.
REQUESTS_SQL = """
SELECT event_id,
  CASE event_id % 5
    WHEN 0 THEN concat('203.0.113.', CAST(user_id % 256 AS STRING), ', 10.0.0.2')
    WHEN 1 THEN ''
    WHEN 2 THEN NULL
    WHEN 3 THEN concat(' 198.51.100.', CAST(user_id % 256 AS STRING), ' ')
    ELSE concat(' , 10.1.', CAST(user_id % 256 AS STRING), '.1') END AS forwarded_for,
  CASE event_id % 3
    WHEN 0 THEN concat('10.0.0.', CAST(user_id % 256 AS STRING), ':54321')
    WHEN 1 THEN concat('[2001:db8::', CAST(user_id % 256 AS STRING), ']:443')
    ELSE concat('192.0.2.', CAST(user_id % 256 AS STRING)) END AS remote_addr
FROM {events}"""


@register(
    "f12_client_key",
    "SELECT event_id, forwarded_for, remote_addr, CASE WHEN coalesce(forwarded_for, '') <> '' THEN "
    + d_trim("split_part(forwarded_for, ',', 1)")
    + r""" WHEN regexp_matches(remote_addr, '^\[[^\]]*\]:[^:\[\]]*$') THEN regexp_extract(remote_addr, '^\[([^\]]*)\]', 1)
  WHEN regexp_matches(remote_addr, '^[^:\[\]]*:[^:\[\]]*$') THEN regexp_extract(remote_addr, '^([^:]*):', 1)
  ELSE remote_addr END AS client_key FROM ("""
    + REQUESTS_SQL.replace("{events}", "events")
    + ")",
)
def f12_client_key(fx: Fixtures):
    """rate-limit key of each request."""
    req = fx.sql(REQUESTS_SQL)
    return req.select("event_id", "forwarded_for", "remote_addr", client_key("forwarded_for", "remote_addr").alias("client_key"))


def _d_quality() -> str:
    parts = []
    for c, k in RAW_FIELDS:
        v = {NUMERIC: d_num, INTEGER: d_int, TEXT: d_text}[k](c)
        parts.append(
            f"SELECT '{c}' AS campo, '{k}' AS tipo, CAST(count(*) AS BIGINT) AS rows, "
            f"CAST(count_if({d_text(c)} IS NOT NULL) AS BIGINT) AS filled, "
            f"CAST(count_if({d_text(c)} IS NOT NULL AND ({v}) IS NULL) AS BIGINT) AS invalid FROM fx_raw"
        )
    return duckdb_with("fx_raw") + "\nUNION ALL\n".join(parts)


@register("s11_quality_report", _d_quality())
def s11_quality_report(fx: Fixtures):
    """Filled and unparsable values per raw field (one aggregate pass)."""
    return quality_report(fx["fx_raw"], RAW_FIELDS)


