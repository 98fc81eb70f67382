"""U13 archive by archive: damaged archives, other contents than the name says, and the next run."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from cadastre.fixtures import CURR_MONTH, DETECTED_AT
from cadastre.plans import run_month as run_module
from cadastre.plans.run_month import plain_path, run_month
from cadastre.plans.store import Store
from cadastre.schema import FILE_LEDGER, MONTH_LEDGER, TABLES
from cadastre.session import scratch_path
from cadastre.sources.archives import expand_archives

ROWS = '"{key:08d}";"EMPRESA {key}";"2062";"50";"1,00";"5";""\n'


def pack(path, **members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return path


def companies(first, n):
    return "".join(ROWS.format(key=k) for k in range(first, first + n))


def ledger(store):
    return sorted((r["filename"], r["status"]) for r in store.read("file_ledger", FILE_LEDGER).collect())


def load(spark, store, archives, root, **more):
    return run_month(spark, store, archives, CURR_MONTH, DETECTED_AT, f"{root}/staging", export=False, index=False, **more)


def test_expand_records_what_is_damaged(spark):
    d = scratch_path(spark, "damaged")
    good = pack(f"{d}/Good.zip", K_EMPRECSV=companies(1, 3))
    with open(f"{d}/Text.zip", "w") as f:
        f.write("no archive")
    cut = pack(f"{d}/Cut.zip", A_EMPRECSV=companies(1, 2), B_EMPRECSV=companies(5, 5000))
    data = bytearray(open(cut, "rb").read())
    at = data.index(b"B_EMPRECSV") + 200
    data[at : at + 40] = b"x" * 40  # the second member is damaged
    with open(cut, "wb") as f:
        f.write(data)
    df = spark.createDataFrame([(p,) for p in (good, f"{d}/Text.zip", cut, f"{d}/Missing.zip")], "archive string")
    out = expand_archives(df, f"{d}/out", errors=True).collect()
    found = {os.path.basename(r["archive"]): r for r in out}
    assert len(out) == 4 and found["Good.zip"]["error"] is None and found["Good.zip"]["member"] == "K_EMPRECSV"
    for name in ("Text.zip", "Cut.zip", "Missing.zip"):  # one row each, none of its members
        assert found[name]["member"] is None and found[name]["error"]
    assert not [n for n in os.listdir(f"{d}/out/Cut") if n.startswith("_")]  # no half-written file
    with pytest.raises(Exception):
        expand_archives(df, f"{d}/out").collect()


def test_good_archives_are_published(spark):
    root = scratch_path(spark, "outcome")
    store = Store(spark, f"{root}/store")
    page = "<html><body>gone</body></html>\n" * 3
    archives = [pack(f"{root}/zips/Empresas0.zip", K_EMPRECSV=companies(1, 10)), pack(f"{root}/zips/Empresas1.zip", K_EMPRECSV=page, L_EMPRECSV=companies(50, 5)),
                pack(f"{root}/zips/Leiame.zip", LEIAME_TXT="x"), pack(f"{root}/zips/Vazio.zip", K_EMPRECSV="")]
    with open(f"{root}/zips/Empresas2.zip", "w") as f:
        f.write("no archive")
    done = load(spark, store, [*archives, f"{root}/zips/Empresas2.zip"], root)
    assert set(done["failed"]) == {"Empresas1.zip", "Empresas2.zip"} and done["no_match"] == ["Leiame.zip"]
    assert "key" in done["failed"]["Empresas1.zip"] and done["failed"]["Empresas2.zip"]
    # an archive is one unit: its good member is not loaded either
    assert store.read("empresa", TABLES["empresa"].struct).count() == 10 and store.rows("empresa") == 10
    assert ledger(store) == [("Empresas0.zip", "SUCCESS"), ("Empresas1.zip", "FAILED"), ("Empresas2.zip", "FAILED"), ("Vazio.zip", "SUCCESS")]
    assert store.read("month_ledger", MONTH_LEDGER).count() == 0
    # the next run takes up what failed, and nothing else
    pack(f"{root}/zips/Empresas1.zip", K_EMPRECSV=companies(40, 5), L_EMPRECSV=companies(50, 5))
    pack(f"{root}/zips/Empresas2.zip", K_EMPRECSV=companies(60, 1))
    done = load(spark, store, [*archives, f"{root}/zips/Empresas2.zip"], root)
    assert done["failed"] == {} and done["archives"] == 3  # the one without a table stays pending
    assert store.rows("empresa") == store.read("empresa", TABLES["empresa"].struct).count() == 21
    assert store.read("month_ledger", MONTH_LEDGER).count() == 1
    assert ("Empresas1.zip", "SUCCESS") in ledger(store) and ("Empresas2.zip", "SUCCESS") in ledger(store)


def test_all_archives_fail(spark):
    root = scratch_path(spark, "all-fail")
    store = Store(spark, f"{root}/store")
    os.makedirs(f"{root}/zips")
    with open(f"{root}/zips/Empresas0.zip", "w") as f:
        f.write("no archive")
    done = load(spark, store, [f"{root}/zips/Empresas0.zip"], root)
    assert list(done["failed"]) == ["Empresas0.zip"] and ledger(store) == [("Empresas0.zip", "FAILED")] and not store.has("empresa")


def test_a_member_that_cannot_be_read(spark, monkeypatch):
    """A fault while reading costs the member's archive, not the month."""
    root = scratch_path(spark, "unreadable")
    store = Store(spark, f"{root}/store")
    archives = [pack(f"{root}/zips/Empresas{i}.zip", **{f"K{i}_EMPRECSV": companies(10 * i, 5)}) for i in range(2)]
    real = run_module.load_typed

    def typed(spark_, paths, spec, *more):
        out = real(spark_, paths, spec, *more)
        if any("K1_EMPRECSV" in p for p in paths):
            out = out.withColumn("razao_social", F.when(F.col("_file").contains("K1_"), F.raise_error(F.lit("torn")).cast("string")).otherwise(F.col("razao_social")))
        return out

    monkeypatch.setattr(run_module, "load_typed", typed)
    done = load(spark, store, archives, root)
    assert list(done["failed"]) == ["Empresas1.zip"] and store.rows("empresa") == 5


def test_plain_path():
    assert plain_path("file:///a/b%20c.csv") == plain_path("/a/b c.csv") == plain_path("file:/a/b c.csv") == "a/b c.csv"
