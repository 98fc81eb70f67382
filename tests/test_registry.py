"""The facade end to end: a month loaded from archives, then the questions."""

from cadastre.catalog.ingest import stage_month
from cadastre.fixtures import CURR_MONTH, DETECTED_AT, PREV_MONTH
from cadastre.plans.run_month import StaleMonthError
from cadastre.registry import Registry
from cadastre.session import scratch_path


def test_registry_two_months(spark, fx):
    root = scratch_path(spark, "test-registry")
    reg = Registry(spark, f"{root}/store")
    reg.load_month(stage_month(fx, "_prev", PREV_MONTH, root), PREV_MONTH, DETECTED_AT)
    out = reg.load_month(stage_month(fx, "_curr", CURR_MONTH, root), CURR_MONTH, DETECTED_AT)
    assert out["tables"]["empresa"]["changed"] > 0
    # loading the same archives again: nothing pending, the month is still recorded
    again = reg.load_month(stage_month(fx, "_curr", CURR_MONTH, root + "/again"), CURR_MONTH, DETECTED_AT)
    assert again["tables"] == {} or all(v.get("log_rows", 0) == 0 for v in again["tables"].values())
    # After a reset the same archives are pending again
    reg.reset_month(CURR_MONTH)
    redo = reg.load_month(stage_month(fx, "_curr", CURR_MONTH, root + "/redo"), CURR_MONTH, DETECTED_AT)
    assert redo["tables"]["empresa"]["changed"] == 0 and redo["tables"]["empresa"]["new"] == 0
    # an older month is refused
    try:
        reg.load_month([], "2026-01", DETECTED_AT)
        raise AssertionError("expected refusal")
    except StaleMonthError:
        pass
    key = fx["fx_estabelecimento_curr"].select("cnpj_basico", "cnpj_ordem", "cnpj_dv").first()
    req = spark.createDataFrame([(f"{key[0]}{key[1]}{key[2]}",), ("00000000999999",)], "requested string")
    prof = {r["requested"]: r for r in reg.profiles(req).collect()}
    assert prof[f"{key[0]}{key[1]}{key[2]}"]["found"] and not prof["00000000999999"]["found"]
    one = reg.profile(f"{key[0]}.{key[1]}/{key[2]}").collect()
    bulk = prof[f"{key[0]}{key[1]}{key[2]}"].asDict()
    assert len(one) == 1 and all(one[0][c] == bulk[c] for c in one[0].asDict())
    assert reg.profile("00000000999999").count() == 0 and reg.profile("123").count() == 0
    hist = reg.history(spark.createDataFrame([(key[0],)], "requested string"))
    one_h = reg.history_of(key[0] + "000100")
    assert sorted(map(tuple, hist.collect())) == sorted(map(tuple, one_h.collect()))
    assert reg.history_of("99999999").count() == 0
    res = reg.search("ring", limit=10).collect()
    assert 0 < len(res) <= 10 and {r["source"] for r in res} == {"prefix"}
    st = reg.stats("exact").collect()[0]
    assert st["latest_month"] == CURR_MONTH and st["empresas"] > 0
    assert reg.stats("estimate")["empresa"] == st["empresas"]
