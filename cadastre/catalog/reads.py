"""Read-side queries: J1-J4 joins."""

from __future__ import annotations

from ..fixtures import Fixtures, duckdb_with
from ..operators.joins import lookup_existing, new_keys, profiles, registry_view
from .base import register

REGISTRY_CTES = duckdb_with(
    "fx_estabelecimento", "fx_empresa", "fx_simples", "fx_cnae", "fx_municipio", "fx_motivo", "fx_natureza"
)

# Companies first (one row each, with or without a tax opt-in), then the branches; code texts are looked up.
J1_SQL = """
, company AS (
  SELECT cnpj_basico, m.razao_social, m.natureza_juridica AS nature, t.opcao_pelo_simples, t.opcao_mei
  FROM fx_empresa AS m FULL JOIN fx_simples AS t USING (cnpj_basico))
SELECT b.cnpj_basico || b.cnpj_ordem || b.cnpj_dv AS cnpj,
  c.razao_social, b.nome_fantasia, b.uf, b.situacao_cadastral, b.telefone_1,
  CAST(NULL AS VARCHAR) AS correio_eletronico,
  c.opcao_pelo_simples, c.opcao_mei, b.cnae_fiscal_principal,
  (SELECT k.descricao FROM fx_cnae AS k WHERE k.codigo = b.cnae_fiscal_principal) AS cnae_fiscal_principal_descricao,
  (SELECT k.descricao FROM fx_municipio AS k WHERE k.codigo = b.municipio) AS municipio,
  (SELECT k.descricao FROM fx_natureza AS k WHERE k.codigo = c.nature) AS natureza_juridica,
  (SELECT k.descricao FROM fx_motivo AS k WHERE k.codigo = b.motivo_situacao_cadastral) AS motivo_situacao_cadastral
FROM fx_estabelecimento AS b LEFT JOIN company AS c ON c.cnpj_basico = b.cnpj_basico
"""


@register("j1_registry_view", REGISTRY_CTES.rstrip() + J1_SQL)
def j1_registry_view(fx: Fixtures):
    """The denormalised view over every branch."""
    return registry_view(fx.registry())


# Requested keys: every branch key written with the usual mask, every company
# with an unknown branch, and every company root alone (invalid: 8 characters).
REQUESTS_SQL = """
SELECT concat(substr(cnpj_basico,1,2), '.', substr(cnpj_basico,3,3), '.', substr(cnpj_basico,6,3), '/',
              cnpj_ordem, '-', cnpj_dv) AS requested
FROM {fx_estabelecimento}
UNION ALL
SELECT concat(cnpj_basico, '9999', '00') AS requested FROM {fx_empresa}
UNION ALL
SELECT cnpj_basico AS requested FROM {fx_simples}
"""

J2_SQL = """
, w AS (
  SELECT requested, cnpj_clean, length(cnpj_clean) = 14 AS is_valid,
    substr(cnpj_clean,1,8) AS b, substr(cnpj_clean,9,4) AS o, substr(cnpj_clean,13,2) AS d
  FROM (SELECT requested, regexp_replace(requested, '[^a-zA-Z0-9]', '', 'g') AS cnpj_clean FROM req)
), prof AS (
  SELECT e.cnpj_basico, e.cnpj_ordem, e.cnpj_dv,
    e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv AS cnpj,
    coalesce(emp.razao_social, '') AS razao_social,
    coalesce(e.nome_fantasia, '') AS nome_fantasia,
    coalesce(e.situacao_cadastral, 0) AS situacao_cadastral,
    CAST(0 AS BIGINT) AS data_inicio_atividade,
    coalesce(e.uf, '') AS uf,
    coalesce(e.municipio, 0) AS municipio,
    coalesce(e.tipo_logradouro, '') || ' ' || coalesce(e.logradouro, '') || ', ' || coalesce(e.numero, '') || ' ' || coalesce(e.complemento, '') AS logradouro,
    '' AS bairro, '' AS cep,
    '(' || coalesce(e.ddd_1, '') || ') ' || coalesce(e.telefone_1, '') AS telefone,
    '' AS email,
    coalesce(s.opcao_pelo_simples, 'N') AS opcao_simples,
    coalesce(s.opcao_mei, 'N') AS opcao_mei
  FROM fx_estabelecimento e
  LEFT JOIN fx_empresa emp ON e.cnpj_basico = emp.cnpj_basico
  LEFT JOIN fx_simples s ON e.cnpj_basico = s.cnpj_basico
)
SELECT w.requested, w.cnpj_clean, w.is_valid, prof.cnpj, prof.razao_social, prof.nome_fantasia,
  prof.situacao_cadastral, prof.data_inicio_atividade, prof.uf, prof.municipio, prof.logradouro,
  prof.bairro, prof.cep, prof.telefone, prof.email, prof.opcao_simples, prof.opcao_mei,
  prof.cnpj IS NOT NULL AS found
FROM w LEFT JOIN prof ON w.is_valid AND prof.cnpj_basico = w.b AND prof.cnpj_ordem = w.o AND prof.cnpj_dv = w.d
"""


def _requests_duck() -> str:
    return (
        REQUESTS_SQL.replace("{fx_estabelecimento}", "fx_estabelecimento")
        .replace("{fx_empresa}", "fx_empresa")
        .replace("{fx_simples}", "fx_simples")
    )


@register(
    "j2_profiles",
    duckdb_with("fx_estabelecimento", "fx_empresa", "fx_simples").rstrip()
    + ", req AS ("
    + _requests_duck()
    + ")"
    + J2_SQL,
)
def j2_profiles(fx: Fixtures):
    """J2 bulk: profile of every requested key (found or not)."""
    requests = fx.sql(REQUESTS_SQL)
    return profiles(fx.registry(), requests).drop("cnpj_basico", "cnpj_ordem", "cnpj_dv")


KEYS3 = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]


@register(
    "j3_existing",
    duckdb_with("fx_estabelecimento_prev", "fx_estabelecimento_curr")
    + """
SELECT p.* FROM fx_estabelecimento_prev p
WHERE EXISTS (SELECT 1 FROM fx_estabelecimento_curr c
  WHERE c.cnpj_basico = p.cnpj_basico AND c.cnpj_ordem = p.cnpj_ordem AND c.cnpj_dv = p.cnpj_dv)
""",
)
def j3_existing(fx: Fixtures):
    """Stored branches whose composite key is in the incoming snapshot."""
    return lookup_existing(fx["fx_estabelecimento_prev"], fx["fx_estabelecimento_curr"], KEYS3)


@register(
    "j4_new_keys",
    duckdb_with("fx_estabelecimento_prev", "fx_estabelecimento_curr")
    + """
SELECT c.* FROM fx_estabelecimento_curr c
WHERE NOT EXISTS (SELECT 1 FROM fx_estabelecimento_prev p
  WHERE c.cnpj_basico = p.cnpj_basico AND c.cnpj_ordem = p.cnpj_ordem AND c.cnpj_dv = p.cnpj_dv)
""",
)
def j4_new_keys(fx: Fixtures):
    """Incoming branches whose key is not stored."""
    return new_keys(fx["fx_estabelecimento_prev"], fx["fx_estabelecimento_curr"], KEYS3)


