"""Value tables for the column functions."""

import pytest
from pyspark.sql import functions as F

from cadastre.functions import (
    address_line,
    bulk_tsv_value,
    canonical_text,
    client_key,
    clamp_limit,
    cnpj_clean,
    phone_label,
    prefix_terms,
    prefix_terms_py,
    sanitize_value,
    zero_value,
)
from cadastre.schema import INTEGER, NUMERIC, TEXT
from cadastre.sources.routing import route_column


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("o")).collect()[0]["o"]


ROUTES = [
    ("F.K03200$Z.D60711.CNAECSV", "cnae"),
    ("K3241.K03200Y0.D60711.EMPRECSV", "empresa"),
    ("K3241.K03200Y0.D60711.ESTABELE", "estabelecimento"),
    ("K3241.K03200Y0.D60711.SOCIOCSV", "socios"),
    ("F.K03200$W.SIMPLES.CSV.D60711", "simples"),
    ("F.K03200$Z.D60711.MOTICSV", "motivo_situacao_cadastral"),
    ("F.K03200$Z.D60711.MUNICCSV", "municipio"),
    ("F.K03200$Z.D60711.NATJUCSV", "natureza_juridica"),
    ("F.K03200$Z.D60711.PAISCSV", "pais"),
    ("F.K03200$Z.D60711.QUALSCSV", "qualificacao_socio"),
    ("QUALIFICACAO_SOCIO.CSV", "socios"),  # declared order: SOCIO before QUAL
    ("k3241.d60711.estabele", "estabelecimento"),
    ("LEIAME.TXT", None),
]


@pytest.mark.parametrize("name,table", ROUTES)
def test_route_files(spark, name, table):
    assert one(spark, route_column, name) == table


BULK = [
    ("", TEXT, "\\N"),
    ("  ", NUMERIC, "\\N"),
    ("1234,56", NUMERIC, "1234.56"),
    ("abc", NUMERIC, "\\N"),
    ("abc", INTEGER, "\\N"),
    ("42", INTEGER, "42"),
    ("a\tb", TEXT, "a\\tb"),
    ("a\nb", TEXT, "a\\nb"),
    ("a\\b", TEXT, "a\\\\b"),
]


@pytest.mark.parametrize("val,kind,want", BULK)
def test_bulk_tsv_value(spark, val, kind, want):
    assert one(spark, lambda c: bulk_tsv_value(c, kind), val) == want


PREFIX = [
    ("taruga", "+taruga*"),
    ("agencia taruga", "+agencia* +taruga*"),
    ("ab", None),
    ("agencia ab taruga", None),
    ("", None),
    ("   ", None),
    ("a+b", None),
    ("taru+ga", "+taruga*"),
    ('+-<>()~*"@word', "+word*"),
]


@pytest.mark.parametrize("q,want", PREFIX)
def test_prefix_terms(spark, q, want):
    assert one(spark, prefix_terms, q) == want
    py = prefix_terms_py(q)
    assert (None if py is None else " ".join(f"+{t}*" for t in py)) == want


SANITIZE = [
    ("1000,00", NUMERIC, "1000.00"),
    (" 0,125 ", NUMERIC, "0.13"),
    ("1.234,56", NUMERIC, None),
    ("NaN", NUMERIC, None),
    ("1e3", NUMERIC, "1000.00"),
    ("007", INTEGER, "7"),
    ("+5", INTEGER, "5"),
    ("5.0", INTEGER, None),
    ("99999999999999999999", INTEGER, None),
    ("\xa0 x \t", TEXT, "x"),
    ("   ", TEXT, None),
]


@pytest.mark.parametrize("val,kind,want", SANITIZE)
def test_sanitize(spark, val, kind, want):
    got = one(spark, lambda c: sanitize_value(c, kind).cast("string"), val)
    assert got == want
    assert one(spark, lambda c: canonical_text(c, kind), val) == (want or "")
    zero = one(spark, lambda c: zero_value(c, kind).cast("string"), val)
    assert zero == (want if want is not None else {NUMERIC: "0.00", INTEGER: "0", TEXT: ""}[kind])


def test_cnpj_clean(spark):
    assert one(spark, cnpj_clean, "12.ABC.345/01DE-35") == "12ABC34501DE35"


def test_formatting(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a string, b string, c string, d string")
    r = df.select(address_line("a", "b", "c", "d").alias("x"), phone_label("a", "b").alias("y")).collect()[0]
    assert r["x"] == " ,  " and r["y"] == "() "


@pytest.mark.parametrize(
    "xff,addr,want",
    [
        ("203.0.113.7, 10.0.0.2", "10.0.0.1:54321", "203.0.113.7"),
        (None, "10.0.0.1:54321", "10.0.0.1"),
        ("", "[2001:db8::1]:443", "2001:db8::1"),
        (None, "192.0.2.1", "192.0.2.1"),
    ],
)
def test_client_key(spark, xff, addr, want):
    df = spark.createDataFrame([(xff, addr)], "x string, a string")
    assert df.select(client_key("x", "a").alias("k")).collect()[0]["k"] == want


def test_clamp_limit():
    assert [clamp_limit(x) for x in (0, -1, 101, 20, 100, 1)] == [20, 20, 20, 20, 100, 1]


def test_cluster_settings_scale_with_input():
    from cadastre.session import cluster_settings

    small = cluster_settings(10 * 2**30, 10, 4)
    big = cluster_settings(100 * 2**40, 1000, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 120
    assert int(big["spark.sql.shuffle.partitions"]) == 100_000
    assert int(cluster_settings(2 * 2**40, 1000, 8)["spark.sql.shuffle.partitions"]) == 24_000
