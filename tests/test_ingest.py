"""Raw-byte CSV fixture and archive expansion."""

import io
import os
import zipfile

from pyspark.sql import functions as F

from cadastre.schema import TABLES
from cadastre.session import scratch_path
from cadastre.sources.archives import expand_archives, safe_member
from cadastre.sources.csv import load_typed, read_registry_csv

RAW = (
    '"11111111";"AÇÚCAR; CIA";"2062";"50";"1000,00";"5";""\n'
    '"22222222";"DIZ ""OLÁ""";"2062";"50";"1,5";"5";"X"\n'
    '"33333333";"STRAY "q" IN";"1";"1";"abc";"1"\n'
    "\n"
    '"44444444";"CURTA"\n'
    '"55555555";"LONGA";"1";"1";"2";"3";"4";"EXTRA";"MAIS"\n'
    '"66666666";"LINHA\nQUEBRADA";"1";"1";"2";"3";"4"\n'
    '"77777777";"BARRA\\";"1";"1";"2";"3";"4"\n'
    '"\xa088888888\xa0";"  PAD  ";"";"";"";"";""\n'
)


def test_raw_bytes(spark):
    d = scratch_path(spark, "test-csv")
    p = os.path.join(d, "empresas.csv")
    with open(p, "wb") as f:
        f.write(RAW.encode("latin-1"))
    rows = {r["cnpj_basico"]: r for r in load_typed(spark, [p], TABLES["empresa"]).collect()}
    assert rows["11111111"]["razao_social"] == "AÇÚCAR; CIA"
    assert str(rows["11111111"]["capital_social"]) == "1000.00"
    assert rows["11111111"]["ente_federativo_responsavel"] is None
    assert rows["22222222"]["razao_social"] == 'DIZ "OLÁ"'
    assert rows["33333333"]["razao_social"] == 'STRAY "q" IN'
    assert rows["33333333"]["capital_social"] is None
    assert rows["44444444"]["natureza_juridica"] is None  # short row → NULL tail
    assert rows["55555555"]["ente_federativo_responsavel"] == "4"  # surplus fields dropped
    assert rows["66666666"]["razao_social"] == "LINHA\nQUEBRADA"
    assert rows["77777777"]["razao_social"] == "BARRA\\"
    assert rows["88888888"]["razao_social"] == "PAD"
    assert len(rows) == 8  # blank line skipped


def test_file_order_kept(spark):
    d = scratch_path(spark, "test-order")
    p = os.path.join(d, "e.csv")
    with open(p, "w", encoding="latin-1") as f:
        for i in range(2000):
            f.write(f'"{i:08d}";"N"\n')
    df = read_registry_csv(spark, [p], TABLES["empresa"], multi_line=False)
    got = [r["cnpj_basico"] for r in df.orderBy("_file", "_ord").collect()]
    assert got == [f"{i:08d}" for i in range(2000)]


def test_expand_archives(spark):
    d = scratch_path(spark, "test-zip")
    a = os.path.join(d, "Empresas0.zip")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("K3241.EMPRECSV", '"1";"A"\n')
        z.writestr("dir/", "")
        z.writestr("../escape.csv", "x")
    with open(a, "wb") as f:
        f.write(buf.getvalue())
    df = spark.createDataFrame([(a,)], "archive string")
    out = expand_archives(df, os.path.join(d, "out")).collect()
    assert [r["member"] for r in out] == ["K3241.EMPRECSV"]
    assert os.path.exists(out[0]["path"]) and out[0]["bytes"] == 8


def test_safe_member():
    assert safe_member("../x") is None and safe_member("a/../../x") is None
    assert safe_member("a/b.csv") == "a/b.csv" and safe_member("d/") is None
    assert safe_member("..foo") is None


def test_one_archive_a_task(spark):
    from cadastre.sources.archives import _fs, _spread

    df = spark.createDataFrame([(f"Estabelecimentos{i}.zip",) for i in range(37)], "archive string").repartition(5)
    rows = _spread(df, "archive").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(rows) == 37 and {r["count"] for r in rows} == {1}
    assert _fs("file:/tmp/x")[1] == _fs("file:///tmp/x")[1] == _fs("/tmp/x")[1] == "/tmp/x"


def test_retried_member_leaves_no_parts(spark):
    d = scratch_path(spark, "test-retry")
    with zipfile.ZipFile(os.path.join(d, "A.zip"), "w") as z:
        z.writestr("K.EMPRECSV", '"1";"A"\n')
    df = spark.createDataFrame([(os.path.join(d, "A.zip"),)], "archive string")
    for _ in range(2):
        assert expand_archives(df, os.path.join(d, "out")).count() == 1
    assert os.listdir(os.path.join(d, "out", "A")) == ["K.EMPRECSV"]


def test_odd_lines_unsplit_their_own_file_only(spark):
    from cadastre.sources.csv import _unsplit

    d = scratch_path(spark, "test-unsplit")
    plain, broken, small = (os.path.join(d, n) for n in ("plain.csv", "broken.csv", "small.csv"))
    for path, rows in ((plain, ['"{i:08d}";"N"']), (broken, ['"{i:08d}";"N\nM"'])):
        with open(path, "w", encoding="latin-1") as f:
            f.write("".join(rows[0].format(i=i) + "\n" for i in range(3000)))
    with open(small, "w", encoding="latin-1") as f:
        f.write('"99999999";"X"\n')
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        whole, split = _unsplit(spark, [plain, broken, small])
        assert sorted(whole) == sorted([broken, small]) and split == [plain]
        rows = load_typed(spark, [plain, broken, small], TABLES["empresa"], "auto").select("cnpj_basico", "razao_social").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 6001 and sum(r["razao_social"] == "N\nM" for r in rows) == 3000


def test_multiline_auto(spark):
    from cadastre.sources.csv import has_quoted_newlines

    d = scratch_path(spark, "test-ml")
    plain, broken = os.path.join(d, "plain.csv"), os.path.join(d, "broken.csv")
    with open(plain, "w", encoding="latin-1") as f:
        f.write('"1";"A ""B"" C"\n"2";"D"\n')
    with open(broken, "w", encoding="latin-1") as f:
        f.write('"1";"LINHA\nQUEBRADA"\n"2";"D"\n')
    assert not has_quoted_newlines(spark, [plain])
    assert has_quoted_newlines(spark, [plain, broken])
    rows = {r["cnpj_basico"]: r["razao_social"] for r in load_typed(spark, [broken], TABLES["empresa"], "auto").collect()}
    assert rows == {"1": "LINHA\nQUEBRADA", "2": "D"}
    rows = {r["cnpj_basico"]: r["razao_social"] for r in load_typed(spark, [plain], TABLES["empresa"], "auto").collect()}
    assert rows == {"1": 'A "B" C', "2": "D"}


def test_a_large_month_is_staged_in_more_archives(spark, fx, monkeypatch):
    from cadastre.catalog import ingest

    names = lambda archives: sum(a.rsplit("/", 1)[-1].startswith("Estabelecimentos") for a in archives)
    monkeypatch.setattr(ingest, "STAGED_BYTES", 10_000)
    assert names(ingest.stage_month(fx, "_curr", "2026-09", scratch_path(spark, "staged"))) == 2
    assert names(ingest.stage_month(fx, "_curr", "2026-09", scratch_path(spark, "spread"), spread=True)) > 2
