"""Read-side operators: Q1-Q3 statistics, Q4 change history, Q5 search
documents and Q6 paging."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cnpj_clean, cnpj_full, zero_int, zero_text

KEYS3 = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]
HISTORY_SALT = 8


def _tagged_union(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for tag, df in frames.items():
        t = df.select(F.lit(tag).alias("_t"))
        out = t if out is None else out.unionByName(t)
    return out


def stats_exact(tables: dict[str, DataFrame], latest_month: DataFrame | None = None) -> DataFrame:
    """Q1: exact row counts of empresa, estabelecimento and socios in one job
    (a tagged union and one aggregate: no joins), plus the latest processed month."""
    u = _tagged_union({t: tables[t] for t in ("empresa", "estabelecimento", "socios")})
    counts = u.agg(
        F.count_if(F.col("_t") == "empresa").alias("empresas"),
        F.count_if(F.col("_t") == "estabelecimento").alias("estabelecimentos"),
        F.count_if(F.col("_t") == "socios").alias("socios"),
    )
    if latest_month is None:
        return counts.withColumn("latest_month", F.lit(None).cast("string"))
    # Both sides are single-row aggregates: a union plus one more aggregate keeps it join-free.
    lm = latest_month.select(F.col("latest_processed").alias("_lm"))
    both = counts.select("*", F.lit(None).cast("string").alias("_lm")).unionByName(
        lm.select(
            F.lit(None).cast("bigint").alias("empresas"),
            F.lit(None).cast("bigint").alias("estabelecimentos"),
            F.lit(None).cast("bigint").alias("socios"),
            "_lm",
        )
    )
    return both.agg(
        F.max("empresas").alias("empresas"),
        F.max("estabelecimentos").alias("estabelecimentos"),
        F.max("socios").alias("socios"),
        F.max("_lm").alias("latest_month"),
    )


def stats_from_commits(commits: list[dict], items=("empresa", "estabelecimento", "socios")) -> dict[str, int]:
    """Q2: row estimate from stored metadata only (the commit log), no scan: the
    newest snapshot and what was appended since; negative or missing → 0."""
    out = {}
    for it in items:
        mine = [c for c in commits if c["item"] == it]
        last = max((c["version"] for c in mine if c["kind"] == "snapshot"), default=-1)
        n = sum(c["rows"] or 0 for c in mine if c["version"] > last or c["version"] == last and c["kind"] == "snapshot")
        out[it] = max(int(n), 0)
    return out


def rows_in_footers(spark: SparkSession, files: dict[str, str | list[str]]) -> DataFrame:
    """Q2 of any Parquet files: ``tabela``, ``files`` and ``rows`` as the files'
    footers tell them, one distributed read of footers in which no column is
    read.  A table whose path is not there has 0 of both."""
    out = None
    for name, paths in files.items():
        try:
            found = spark.read.parquet(*([paths] if isinstance(paths, str) else paths))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            found = spark.createDataFrame([], "x int").select(F.lit("").alias("_f"))
        else:
            found = found.select(F.col("_metadata.file_path").alias("_f"))
        each = found.groupBy("_f").agg(F.count("*").alias("n"))  # combined on the map side: a row a file
        one = each.agg(F.lit(name).alias("tabela"), F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out


#: Q3's sketches: 2 to this power of registers, and the error that holds but for one case in several hundred (three deviations).
SKETCH_BITS = 12
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def key_sketch(keys: list[str]) -> Column:
    """A HyperLogLog sketch of the complete keys, as an aggregate."""
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return F.hll_sketch_agg(F.when(complete, F.xxhash64(*keys)), SKETCH_BITS)


def stats_from_sketches(sketches: dict[str, DataFrame]) -> DataFrame:
    """Q3, approximate: distinct keys of several loads from their stored sketches
    (``sketch``), united; within :data:`SKETCH_ERROR`.  No data row is read."""
    out = None
    for name, df in sketches.items():
        one = df.agg(F.hll_union_agg("sketch").alias("s")).select(
            F.lit(name).alias("tabela"), F.coalesce(F.hll_sketch_estimate("s"), F.lit(0)).cast("bigint").alias("estimate"))
        out = one if out is None else out.unionByName(one)
    return out


def stats_final(tables: dict[str, DataFrame], keyed=(("empresa", ["cnpj_basico"]), ("estabelecimento", KEYS3))) -> DataFrame:
    """Q3: counts after replacing-merge de-duplication: distinct declared keys for
    keyed tables (two-phase distinct aggregation, no single-task collect); socios
    is a multiset and is counted plainly."""
    out = {}
    for t, keys in keyed:
        out[t] = tables[t].select(*keys).distinct().agg(F.count("*").alias("n"))
    out["socios"] = tables["socios"].agg(F.count("*").alias("n"))
    u = None
    for t, df in out.items():
        d = df.select(F.lit(t).alias("_t"), "n")
        u = d if u is None else u.unionByName(d)
    return u.agg(
        F.max(F.when(F.col("_t") == "empresa", F.col("n"))).alias("empresas"),
        F.max(F.when(F.col("_t") == "estabelecimento", F.col("n"))).alias("estabelecimentos"),
        F.max(F.when(F.col("_t") == "socios", F.col("n"))).alias("socios"),
    )


def change_history(log: DataFrame, requests: DataFrame, column: str = "requested") -> DataFrame:
    """Q4 (bulk): change-log rows of each requested company (first 8 characters
    of the cleaned key) with the company's ``total_count``; newest first.

    The log is semi-joined to the request list; counts come from a partial
    (map-side combined) aggregate and are joined back on (company, slot): no
    window over a company, so a company holding a large share of the log is
    not funnelled through one task.  Companies without history return no rows.
    """
    wanted = requests.select(F.substring(cnpj_clean(column), 1, 8).alias("cnpj_basico")).distinct()
    hist = log.join(wanted, "cnpj_basico", "left_semi")
    counts = hist.groupBy("cnpj_basico").agg(F.count("*").alias("total_count"))
    # Salted join-back: each history row takes one of SALT slots round-robin, the
    # per-company count is copied to every slot (a fixed SALT-fold copy of the
    # small side), so one company's rows spread over SALT tasks.  Any slot gives
    # the same answer, so the slot need not be reproducible on a task retry.
    slot = F.pmod(F.monotonically_increasing_id(), F.lit(HISTORY_SALT))
    salted = counts.select("cnpj_basico", "total_count", F.explode(F.sequence(F.lit(0), F.lit(HISTORY_SALT - 1))).alias("_slot"))
    out = hist.withColumn("_slot", slot).join(salted, ["cnpj_basico", "_slot"], "inner").drop("_slot")
    # entries of one detection stamp: the later month first, as its run came later
    return out.orderBy("cnpj_basico", F.desc("detectado_em"), F.desc("competencia"), "tabela", "campo")


def company_history(log: DataFrame, cnpj: str) -> DataFrame:
    """Q4 for one company (the API form): the first 8 characters of the cleaned
    key become a literal filter that reaches the parquet scan (the log files are
    company-sorted, so min/max statistics skip the other row groups); then the
    bulk form above, so even a very large history is counted without a window.
    No history → empty, never an error."""
    import re

    basico = re.sub(r"[^a-zA-Z0-9]", "", cnpj)[:8]
    one = log.sparkSession.createDataFrame([(basico,)], "requested string")
    return change_history(log.where(F.col("cnpj_basico") == F.lit(basico)), one)


def search_documents(tables: dict[str, DataFrame], ordered: bool = True) -> DataFrame:
    """Q5: one zero-valued search document per branch, ordered by key."""
    e = tables["estabelecimento"].select(*KEYS3, "nome_fantasia", "uf", "cnae_fiscal_principal")
    emp = tables["empresa"].select("cnpj_basico", "razao_social")
    docs = e.join(emp, "cnpj_basico", "left")
    if ordered:
        docs = docs.orderBy(*KEYS3)
    return docs.select(
        cnpj_full().alias("cnpj"),
        zero_text("razao_social").alias("razao_social"),
        zero_text("nome_fantasia").alias("nome_fantasia"),
        zero_text("uf").alias("uf"),
        zero_int("cnae_fiscal_principal").alias("cnae"),
    )


def page(docs: DataFrame, order: list[str], offset: int, limit: int) -> DataFrame:
    """Q6: rows [offset, offset+limit) in ``order`` plus ``has_more``, computed by
    taking limit+1 rows (a bounded top-k, never a full count)."""
    window = docs.orderBy(*order).offset(offset).limit(limit + 1)
    # At most limit+1 rows reach these windows (bounded by the page size).
    ranked = window.withColumn("_pos", F.row_number().over(Window.orderBy(*order)))
    ranked = ranked.withColumn("_n", F.count("*").over(Window.partitionBy()))
    return ranked.where(F.col("_pos") <= limit).select(*docs.columns, (F.col("_n") > limit).alias("has_more"))


def keyset_page(docs: DataFrame, key: str, after: str | None, limit: int) -> DataFrame:
    """Q6 for large exports: the next ``limit`` rows after the last key seen (the
    key filter reaches the scan; no OFFSET re-reading)."""
    d = docs if after is None else docs.where(F.col(key) > F.lit(after))
    return d.orderBy(key).limit(limit)
