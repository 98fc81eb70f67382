"""Joins: J1 registry_view, J2 profiles, J3 lookup_existing, J4 new keys,
plus the size-checked broadcast used for the code (domain) tables.

Plan shape of J1 (checked with ``explain`` on a skewed input): empresa ⟗
simples (both unique per company, narrow rows) and then one estabelecimento ⟕
company sort-merge join whose children are plain shuffle stages — the shape
AQE's skew join splits (``SortMergeJoin(skew=true)``) when one company owns a
large share of the branches; two chained left joins on the same key are not
split.  The four code tables are broadcast only after one bounded row count
(a single job for all four) proves them small, otherwise they join by
shuffle.  The big joins carry no hint: Catalyst broadcasts only when the
statistics put a side under the threshold, and AQE re-plans with measured
sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (
    address_line,
    cnpj_clean,
    cnpj_full,
    cnpj_is_valid,
    cnpj_parts,
    opt_in_default,
    phone_label,
    zero_int,
    zero_text,
)

# Rows a code table may hold and still be broadcast (each row is a bigint code
# plus a short description: 200k rows stay well below a few tens of MB).
BROADCAST_MAX_ROWS = 200_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when a bounded count shows at most ``max_rows`` rows,
    else ``df`` unchanged (the join then shuffles; AQE may still convert it)."""
    return small_sides({"_": df}, max_rows)["_"]


def small_sides(frames: dict[str, DataFrame], max_rows: int = BROADCAST_MAX_ROWS) -> dict[str, DataFrame]:
    """``small_side`` for several frames with one job: each input contributes at
    most ``max_rows + 1`` rows to a tagged count, so the check itself is bounded."""
    probe = None
    for tag, df in frames.items():
        p = df.limit(max_rows + 1).select(F.lit(tag).alias("_tag"))
        probe = p if probe is None else probe.unionByName(p)
    counts = {r["_tag"]: r["n"] for r in probe.groupBy("_tag").agg(F.count("*").alias("n")).collect()}
    return {t: (F.broadcast(df) if counts.get(t, 0) <= max_rows else df) for t, df in frames.items()}


def _code_table(df: DataFrame, alias: str, out: str) -> DataFrame:
    return df.select(F.col("codigo").alias(f"_{alias}_codigo"), F.col("descricao").alias(out))


def code_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four code tables of J1, each as a code and its description."""
    return {
        "cnae": _code_table(tables["cnae"], "cnae", "cnae_fiscal_principal_descricao"),
        "mun": _code_table(tables["municipio"], "mun", "_mun_desc"),
        "mot": _code_table(tables["motivo_situacao_cadastral"], "mot", "_mot_desc"),
        "nat": _code_table(tables["natureza_juridica"], "nat", "_nat_desc"),
    }


def registry_columns(branches: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    """The columns of J1 from branches beside their company and opt-in row."""
    j = (
        branches.join(codes["cnae"], F.col("cnae_fiscal_principal") == F.col("_cnae_codigo"), "left")
        .join(codes["mun"], F.col("municipio") == F.col("_mun_codigo"), "left")
        .join(codes["mot"], F.col("motivo_situacao_cadastral") == F.col("_mot_codigo"), "left")
        .join(codes["nat"], F.col("natureza_juridica") == F.col("_nat_codigo"), "left")
    )
    return j.select(
        cnpj_full().alias("cnpj"),
        "razao_social",
        "nome_fantasia",
        "situacao_cadastral",
        F.col("_mot_desc").alias("motivo_situacao_cadastral"),
        "uf",
        F.col("_mun_desc").alias("municipio"),
        "cnae_fiscal_principal_descricao",
        "cnae_fiscal_principal",
        F.col("_nat_desc").alias("natureza_juridica"),
        "correio_eletronico",
        "telefone_1",
        "opcao_pelo_simples",
        "opcao_mei",
    )


def registry_view(tables: dict[str, DataFrame], broadcast_codes: bool = True) -> DataFrame:
    """One row per branch with company, tax opt-in and code descriptions."""
    e = tables["estabelecimento"].select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "nome_fantasia", "situacao_cadastral",
        "motivo_situacao_cadastral", "uf", "municipio", "cnae_fiscal_principal",
        "correio_eletronico", "telefone_1",
    )
    emp = tables["empresa"].select("cnpj_basico", "razao_social", "natureza_juridica")
    s = tables["simples"].select("cnpj_basico", "opcao_pelo_simples", "opcao_mei")
    codes = code_tables(tables)
    if broadcast_codes:
        codes = small_sides(codes)

    # empresa and simples are both unique per cnpj_basico, so one full outer
    # join of the two (narrow rows) followed by a single estabelecimento ⟕ join
    # is the same as two chained left joins — but leaves one sort-merge join
    # whose children are plain shuffle stages, the shape AQE can split when one
    # company owns a large share of the branches (chained joins are not split).
    company = emp.join(s, "cnpj_basico", "full_outer")
    return registry_columns(e.join(company, "cnpj_basico", "left"), codes)


def wanted_keys(requests: DataFrame, column: str = "requested") -> DataFrame:
    """F1/F2 over a frame of requested keys: cleaned key, validity and the three parts."""
    clean = cnpj_clean(column)
    parts = cnpj_parts(clean)
    return requests.select(
        F.col(column).alias("requested"),
        clean.alias("cnpj_clean"),
        cnpj_is_valid(clean).alias("is_valid"),
        # Parts only for valid keys, so an invalid request can never match.
        *[F.when(cnpj_is_valid(clean), v).alias(k) for k, v in parts.items()],
    )


def _profile_columns() -> list:
    """F2-F6 projection of a branch beside its company and opt-in row."""
    return [
        cnpj_full().alias("cnpj"),
        zero_text("razao_social").alias("razao_social"),
        zero_text("nome_fantasia").alias("nome_fantasia"),
        zero_int("situacao_cadastral").alias("situacao_cadastral"),
        zero_int("data_inicio_atividade").alias("data_inicio_atividade"),
        zero_text("uf").alias("uf"),
        zero_int("municipio").alias("municipio"),
        address_line("tipo_logradouro", "logradouro", "numero", "complemento").alias("logradouro"),
        zero_text("bairro").alias("bairro"),
        zero_text("cep").alias("cep"),
        phone_label("ddd_1", "telefone_1").alias("telefone"),
        zero_text("correio_eletronico").alias("email"),
        opt_in_default("opcao_pelo_simples").alias("opcao_simples"),
        opt_in_default("opcao_mei").alias("opcao_mei"),
    ]


def _profile_rows(e: DataFrame, emp: DataFrame, s: DataFrame) -> DataFrame:
    return e.join(emp, "cnpj_basico", "left").join(s, "cnpj_basico", "left").select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", *_profile_columns())


def profile(tables: dict[str, DataFrame], cnpj: str) -> DataFrame:
    """J2 single form: literal key filters reach the parquet scans (min/max and
    row-group skipping on the key-range layout), ``LIMIT 1``; empty when the key
    is invalid or unknown (the reference answers 404)."""
    import re

    clean = re.sub(r"[^a-zA-Z0-9]", "", cnpj)
    if len(clean) != 14:
        return _profile_rows(
            tables["estabelecimento"].where(F.lit(False)), tables["empresa"].select("cnpj_basico", "razao_social"),
            tables["simples"].select("cnpj_basico", "opcao_pelo_simples", "opcao_mei"),
        ).drop("cnpj_basico", "cnpj_ordem", "cnpj_dv")
    b, o, d = clean[:8], clean[8:12], clean[12:14]
    e = tables["estabelecimento"].where(
        (F.col("cnpj_basico") == b) & (F.col("cnpj_ordem") == o) & (F.col("cnpj_dv") == d)
    )
    emp = tables["empresa"].where(F.col("cnpj_basico") == b).select("cnpj_basico", "razao_social")
    s = tables["simples"].where(F.col("cnpj_basico") == b).select("cnpj_basico", "opcao_pelo_simples", "opcao_mei")
    return _profile_rows(e, emp, s).limit(1).drop("cnpj_basico", "cnpj_ordem", "cnpj_dv")


BRANCH_COLUMNS = [
    "nome_fantasia", "situacao_cadastral", "data_inicio_atividade", "uf", "municipio", "tipo_logradouro", "logradouro", "numero",
    "complemento", "bairro", "cep", "ddd_1", "telefone_1", "correio_eletronico",
]


def profiles(tables: dict[str, DataFrame], requests: DataFrame, column: str = "requested") -> DataFrame:
    """J2 (bulk form): one profile row per requested key, ``found`` = a branch exists.

    The valid requests meet company, opt-in and branch in three left joins that
    all hash on the company key, so each input is shuffled once: the joins with
    the company-keyed tables come first and fix the partitioning, which the
    three-part key of the branch join then keeps.  Invalid keys (not 14
    characters after cleaning) never reach a join; they are added at the end
    with ``found = false``.
    """
    w = wanted_keys(requests, column)
    keys3 = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]
    emp = tables["empresa"].select("cnpj_basico", "razao_social")
    s = tables["simples"].select("cnpj_basico", "opcao_pelo_simples", "opcao_mei")
    e = tables["estabelecimento"].select(*keys3, *BRANCH_COLUMNS, F.lit(True).alias("_branch"))
    rows = w.where("is_valid").join(emp, "cnpj_basico", "left").join(s, "cnpj_basico", "left").join(e, keys3, "left")
    found = F.col("_branch").isNotNull()
    names = ["requested", "cnpj_clean", "is_valid"]
    good = rows.select(*names, found.alias("found"), F.struct(*_profile_columns()).alias("_p"))
    good = good.select(*names, *[F.when(F.col("found"), F.col(f"_p.{f.name}")).alias(f.name) for f in good.schema["_p"].dataType], "found")
    bad = w.where("not is_valid or is_valid is null").select(
        *names, *[F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema if f.name not in (*names, "found")], F.lit(False).alias("found"))
    return good.unionByName(bad)


def lookup_existing(state: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows whose key occurs in the incoming batch."""
    return state.join(incoming.select(*keys), keys, "left_semi")


def new_keys(state: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored."""
    return incoming.join(state.select(*keys), keys, "left_anti")
