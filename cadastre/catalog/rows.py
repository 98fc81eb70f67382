"""Queries of the rows that other keys only use: S4, S10, F2-F9, U7, U12, the
keyset form of Q6 and the prefix and ranked legs of Q9."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import CURR_MONTH, DETECTED_AT, PREV_MONTH, Fixtures, duckdb_with
from ..functions import (
    address_line,
    cnpj_full,
    cnpj_parts,
    contains_pattern,
    opt_in_default,
    phone_label,
    uf_condition,
    zero_int,
    zero_text,
)
from ..functions.search_terms import clamped_limit
from ..operators.ledger import reset_month
from ..operators.reads import keyset_page, search_documents
from ..operators.search import search
from ..plans.store import Store
from ..plans.upsert import upsert_tables
from ..schema import TABLES
from ..session import scratch_path
from ..sources.csv import load_typed
from ..sources.listing import archive_url
from .base import ORACLES, register
from .search import DOC_COLS, DOCS_SQL, PREFIX_Q, REG

ESTAB = duckdb_with("fx_estabelecimento")


@register(
    "s4_archive_urls",
    duckdb_with("fx_files")
    + "SELECT data_month, filename, 'https://mirror.invalid/dav/' || data_month || '/' || filename AS bare, "
    + "'https://mirror.invalid/dav/' || data_month || '/' || filename AS slashed FROM fx_files",
)
def s4_archive_urls(fx: Fixtures):
    """An archive's URL, with one slash at each joint whether or not the base ends in one."""
    url = lambda base: archive_url(base, "data_month", "filename")
    return fx["fx_files"].select("data_month", "filename", url("https://mirror.invalid/dav").alias("bare"),
                                 url("https://mirror.invalid/dav//").alias("slashed"))


# Lines of two, seven and nine fields: short ones lack the tail, long ones hold more than the table.
SHAPED_LINES = """
SELECT concat('"', lpad(CAST(c_custkey AS STRING), 8, '0'), '";"', c_name, '"', CASE c_custkey % 3 WHEN 0 THEN ''
  WHEN 1 THEN concat(';"', CAST(c_nationkey AS STRING), '";"1";"10,50";"3";"X"')
  ELSE concat(';"', CAST(c_nationkey AS STRING), '";"1";"10,50";"3";"X";"more";"and more"') END) AS value FROM {customer}"""


@register(
    "s10_shape_rows",
    """
SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS razao_social,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS natureza_juridica,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(10.50 AS DECIMAL(15,2)) END AS capital_social,
  CASE WHEN c_custkey % 3 <> 0 THEN 'X' END AS ente_federativo_responsavel
FROM customer""",
)
def s10_shape_rows(fx: Fixtures):
    """Rows of fewer and of more fields than the table, shaped to its columns."""
    path = scratch_path(fx.spark, "s10") + "/lines"
    fx.sql(SHAPED_LINES).write.text(path)
    rows = load_typed(fx.spark, [path], TABLES["empresa"])
    return rows.select("cnpj_basico", "razao_social", "natureza_juridica", "capital_social", "ente_federativo_responsavel")


@register("f2_cnpj_parts", ESTAB + """
SELECT substr(k, 1, 8) AS cnpj_basico, substr(k, 9, 4) AS cnpj_ordem, substr(k, 13, 2) AS cnpj_dv, k AS cnpj
FROM (SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS k FROM fx_estabelecimento)""")
def f2_cnpj_parts(fx: Fixtures):
    """a whole key taken apart and put together again."""
    whole = fx["fx_estabelecimento"].select(cnpj_full().alias("whole"))
    return whole.select(*[v.alias(k) for k, v in cnpj_parts("whole").items()]).withColumn("cnpj", cnpj_full())


@register("f3_address_line", ESTAB + """
SELECT cnpj_basico, cnpj_ordem, cnpj_dv, coalesce(tipo_logradouro, '') || ' ' || coalesce(logradouro, '') || ', ' ||
  coalesce(numero, '') || ' ' || coalesce(complemento, '') AS address FROM fx_estabelecimento""")
def f3_address_line(fx: Fixtures):
    """one line of an address, missing parts as ''."""
    line = address_line("tipo_logradouro", "logradouro", "numero", "complemento")
    return fx["fx_estabelecimento"].select("cnpj_basico", "cnpj_ordem", "cnpj_dv", line.alias("address"))


@register("f4_phone_label", ESTAB + """
SELECT cnpj_basico, cnpj_ordem, cnpj_dv, '(' || coalesce(ddd_1, '') || ') ' || coalesce(telefone_1, '') AS phone FROM fx_estabelecimento""")
def f4_phone_label(fx: Fixtures):
    """area code and number as one label."""
    return fx["fx_estabelecimento"].select("cnpj_basico", "cnpj_ordem", "cnpj_dv", phone_label("ddd_1", "telefone_1").alias("phone"))


@register("f5_opt_in_default", duckdb_with("fx_empresa", "fx_simples") + """
SELECT m.cnpj_basico, CASE WHEN t.opcao_pelo_simples IS NULL THEN 'N' ELSE t.opcao_pelo_simples END AS simples,
  CASE WHEN t.opcao_mei IS NULL THEN 'N' ELSE t.opcao_mei END AS mei
FROM fx_empresa m LEFT JOIN fx_simples t ON t.cnpj_basico = m.cnpj_basico""")
def f5_opt_in_default(fx: Fixtures):
    """companies without an opt-in row, or with an empty flag, have not opted in."""
    j = fx["fx_empresa"].select("cnpj_basico").join(fx["fx_simples"], "cnpj_basico", "left")
    return j.select("cnpj_basico", opt_in_default("opcao_pelo_simples").alias("simples"), opt_in_default("opcao_mei").alias("mei"))


@register("f6_zero_values", duckdb_with("fx_empresa") + """
SELECT cnpj_basico, CASE WHEN ente_federativo_responsavel IS NULL THEN '' ELSE ente_federativo_responsavel END AS ente,
  CASE WHEN code IS NULL THEN CAST(0 AS BIGINT) ELSE code END AS code
FROM (SELECT *, CASE WHEN porte_empresa <> 2 THEN natureza_juridica END AS code FROM fx_empresa)""")
def f6_zero_values(fx: Fixtures):
    """NULL text as '' and NULL numbers as 0 in what is shown."""
    rows = fx["fx_empresa"].withColumn("code", F.when(F.col("porte_empresa") != 2, F.col("natureza_juridica")))
    return rows.select("cnpj_basico", zero_text("ente_federativo_responsavel").alias("ente"), zero_int("code").alias("code"))


@register("f7_clamp_limit", """
SELECT p_partkey, wanted, CASE WHEN wanted BETWEEN 1 AND 100 THEN wanted ELSE 20 END AS given
FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size * 4 - 40 AS BIGINT) END AS wanted FROM part)""")
def f7_clamp_limit(fx: Fixtures):
    """limits that are missing, not positive or over 100 become 20."""
    asked = fx["part"].select("p_partkey", F.when(F.col("p_partkey") % 9 != 0, (F.col("p_size") * 4 - 40).cast("bigint")).alias("wanted"))
    return asked.select("p_partkey", "wanted", clamped_limit("wanted").alias("given"))


@register("f8_uf_filter", ESTAB + """
SELECT asked, uf, CAST(count(*) AS BIGINT) AS n FROM fx_estabelecimento, (VALUES ('am'), ('AM'), ('')) AS a(asked)
WHERE asked = '' OR uf = upper(asked) GROUP BY asked, uf""")
def f8_uf_filter(fx: Fixtures):
    """F8: an optional place, given in any case."""
    out = None
    for asked in ("am", "AM", ""):
        condition = uf_condition(asked)
        rows = fx["fx_estabelecimento"] if condition is None else fx["fx_estabelecimento"].where(condition)
        one = rows.groupBy("uf").agg(F.count("*").alias("n")).select(F.lit(asked).alias("asked"), "uf", "n")
        out = one if out is None else out.unionByName(one)
    return out


_PATTERNS = ("RING", "e%n", "_lue", "%")


@register("f9_contains_pattern", ESTAB + "\nUNION ALL ".join(
    f"SELECT '{q}' AS q, '%{q.lower()}%' AS pattern, CAST(count(*) AS BIGINT) AS n FROM fx_estabelecimento WHERE lower(nome_fantasia) LIKE '%{q.lower()}%'"
    for q in _PATTERNS))
def f9_contains_pattern(fx: Fixtures):
    """the pattern of a contains search; the user's wildcards stay wildcards."""
    names = F.lower("nome_fantasia")
    found = fx["fx_estabelecimento"].agg(*[F.count_if(names.like(contains_pattern(q))).alias(f"n{i}") for i, q in enumerate(_PATTERNS)])
    rows = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(contains_pattern(q)).alias("pattern"), F.col(f"n{i}").alias("n")) for i, q in enumerate(_PATTERNS)])
    return found.select(F.inline(rows))


@register("u12_reset_month", duckdb_with("fx_ledger") + """
SELECT data_month, filename, status FROM fx_ledger WHERE data_month <> (SELECT min(data_month) FROM fx_ledger)""")
def u12_reset_month(fx: Fixtures):
    """The ledger without one month's rows, so that the month loads again."""
    ledger = fx["fx_ledger"]
    return reset_month(ledger, ledger.agg(F.min("data_month")).first()[0])


@register("q6_keyset_page", REG.rstrip() + DOCS_SQL + "\nUNION ALL ".join(
    f"(SELECT {i} AS page, {DOC_COLS} FROM docs {w} ORDER BY cnpj LIMIT 25)" for i, w in enumerate(("", "WHERE cnpj > '00000050'", "WHERE cnpj > '99'"))))
def q6_keyset_page(fx: Fixtures):
    """Q6, keyset form: the first page, the one after a key, and the one after all keys."""
    docs, out = search_documents(fx.registry(), ordered=False), None
    for i, after in enumerate((None, "00000050", "99")):
        one = keyset_page(docs, "cnpj", after, 25).select(F.lit(i).alias("page"), *DOC_COLS.split(", "))
        out = one if out is None else out.unionByName(one)
    return out


@register("q9_search_prefix", ORACLES["q8_search_prefix"].replace(f"SELECT {DOC_COLS} FROM docs WHERE", f"SELECT {DOC_COLS}, 'prefix' AS source FROM docs WHERE"))
def q9_search_prefix(fx: Fixtures):
    """Q9: the cascade's prefix leg, for terms of three characters or more."""
    return search(fx.registry(), PREFIX_Q, None, 100)


@register("u7_publish", duckdb_with("fx_empresa_prev", "fx_empresa_curr") + """
, after AS (SELECT cnpj_basico FROM fx_empresa_prev UNION SELECT cnpj_basico FROM fx_empresa_curr)
SELECT 'written, not published' AS phase, CAST(1 AS BIGINT) AS version, CAST(count(*) AS BIGINT) AS rows FROM fx_empresa_prev
UNION ALL SELECT 'of two runs, the first', CAST(2 AS BIGINT), CAST(count(*) AS BIGINT) FROM after
UNION ALL SELECT 'the old version', CAST(1 AS BIGINT), CAST(count(*) AS BIGINT) FROM fx_empresa_prev""")
def u7_publish(fx: Fixtures):
    """What readers see while a run is written, after one of two runs at once
    has published, and at the version they began with."""
    from ..plans.store import ConflictError

    store, spec, out = Store(fx.spark, scratch_path(fx.spark, "u7")), TABLES["empresa"], None

    def load(suffix: str, month: str):
        tx = store.begin(month)
        upsert_tables(tx, {"empresa": fx.registry(suffix)["empresa"]}, month, DETECTED_AT, order=None)
        return tx

    load("_prev", PREV_MONTH).commit()
    old = store.commits()
    one, two = load("_curr", CURR_MONTH), load("_prev", CURR_MONTH)
    seen = [("written, not published", store.commits())]
    one.commit()
    try:
        two.commit()
        raise AssertionError("two runs published one version")
    except ConflictError:
        seen += [("of two runs, the first", store.commits()), ("the old version", old)]
    for phase, commits in seen:
        version = max(c["version"] for c in commits)
        n = store.read("empresa", spec.struct, commits).agg(F.count("*").alias("rows"))
        n = n.select(F.lit(phase).alias("phase"), F.lit(version).cast("bigint").alias("version"), "rows")
        out = n if out is None else out.unionByName(n)
    return out
