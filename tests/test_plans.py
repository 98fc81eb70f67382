"""Plan properties of every registered query (sf0.001): no cartesian or
nested-loop joins, no row-at-a-time Python, filters reaching the scans."""

import io
import contextlib

import pytest

import __spark_entry__ as E
from cadastre.fixtures import Fixtures
from cadastre.operators.joins import profile
from cadastre.operators.search import search_contains
from cadastre.session import scratch_path

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_cartesian_or_python_rows(spark, key):
    df = E.queries()[key](spark, SF)
    text = plan_of(df)
    for bad in FORBIDDEN:
        assert bad not in text, f"{key}: {bad}"


def test_uf_filter_reaches_scan(spark):
    fx = Fixtures(spark, SF)
    t = fx.registry()
    base = scratch_path(spark, "plan-uf")
    t["estabelecimento"].write.parquet(base + "/e")
    t["estabelecimento"] = spark.read.parquet(base + "/e")
    text = plan_of(search_contains(t, "ring", "am", 10))
    assert "EqualTo(uf,AM)" in text


def test_single_profile_pushes_key_literals(spark):
    fx = Fixtures(spark, SF)
    t = fx.registry()
    base = scratch_path(spark, "plan-profile")
    for name in ("estabelecimento", "empresa", "simples"):
        t[name].write.parquet(f"{base}/{name}")
        t[name] = spark.read.parquet(f"{base}/{name}")
    text = plan_of(profile(t, "00.000.001/0000-01"))
    assert "EqualTo(cnpj_basico,00000001)" in text and "EqualTo(cnpj_ordem,0000)" in text
