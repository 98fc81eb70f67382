"""K2 layouts: bucketed tables without exchanges, a hot company, folders by place."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from cadastre.operators.joins import profiles, registry_view
from cadastre.operators.search import search_contains
from cadastre.plans.colocated import attach, buckets_for, colocated_profiles, colocated_view, write_colocated
from cadastre.plans.places import branches_in, read_places, search_place, write_places
from cadastre.session import scratch_path


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue()


def exchanges(df) -> int:
    """Exchanges of the plan other than broadcasts."""
    return len(re.findall(r"^\(\d+\) Exchange", plan_of(df), re.M))


def rows(df) -> list:
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def crowd(fx):
    """The registry, with a third of all branches held by one company."""
    t = fx.registry()
    hot = t["estabelecimento"].select("cnpj_basico").orderBy("cnpj_basico").first()[0]
    e = t["estabelecimento"]
    many = e.limit(0).unionAll(
        e.where(F.col("cnpj_basico") != hot).withColumn("cnpj_basico", F.when(F.pmod(F.xxhash64("cnpj_ordem", "cnpj_dv"), F.lit(3)) == 0, F.lit(hot)).otherwise(
            F.col("cnpj_basico"))).dropDuplicates(["cnpj_basico", "cnpj_ordem", "cnpj_dv"]))
    return {**t, "estabelecimento": many}, hot


def test_no_exchange_and_the_same_rows(spark, fx):
    t = fx.registry()
    layout = write_colocated(t, scratch_path(spark, "colo") + "/a")
    view = colocated_view(layout, t)
    assert exchanges(view) == 0 and "SortMergeJoin" in plan_of(view)
    assert rows(view) == rows(registry_view(t))
    again = attach(spark, layout.path)
    assert again.buckets == layout.buckets and rows(colocated_view(again, t)) == rows(view)


def test_profiles_move_requests_only(spark, fx):
    t = fx.registry()
    layout = write_colocated(t, scratch_path(spark, "colo") + "/b")
    e = t["estabelecimento"]
    requests = e.select(F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("requested")).union(
        spark.createDataFrame([("1",), (None,), ("99.999.999/9999-99",)], "requested string"))
    got = colocated_profiles(layout, requests)
    text = plan_of(got)
    for table in ("empresa", "simples", "estabelecimento"):  # a bucketed scan, and no exchange over it
        assert re.search(rf"Location: InMemoryFileIndex \[\S*/b/{table}\]\n(.*\n)*?Bucketed|Bucketed: true", text)
    assert exchanges(got) <= 3  # requests to the buckets; requests and branches of hot companies
    assert rows(got) == rows(profiles(t, requests).drop("cnpj_basico", "cnpj_ordem", "cnpj_dv"))


def test_hot_company_is_spread(spark, crowd):
    t, hot = crowd
    layout = write_colocated(t, scratch_path(spark, "colo") + "/c", buckets=8)
    assert {r[0] for r in layout.hot_companies.select("cnpj_basico").collect()} == {hot}
    assert layout.tables["estabelecimento"].where(F.col("cnpj_basico") == hot).count() == 0
    assert layout.hot_companies.count() < layout.buckets
    view = colocated_view(layout, t)
    assert exchanges(view) == 0 and rows(view) == rows(registry_view(t))
    requests = t["estabelecimento"].select(F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("requested"))
    assert rows(colocated_profiles(layout, requests)) == rows(profiles(t, requests).drop("cnpj_basico", "cnpj_ordem", "cnpj_dv"))


def test_bucket_files(spark, fx):
    """One file a bucket, so that a bucket is one task's sorted run."""
    layout = write_colocated(fx.registry(), scratch_path(spark, "colo") + "/d", buckets=8)
    files = layout.tables["estabelecimento"].select(F.col("_metadata.file_name").alias("f"), "cnpj_basico").groupBy("f").agg(
        F.count_distinct("cnpj_basico").alias("keys")).collect()
    assert len(files) <= 8 and sum(r["keys"] for r in files) == layout.tables["estabelecimento"].select("cnpj_basico").distinct().count()
    assert buckets_for(0) == 8 and buckets_for(200_000_000) == 128
    with pytest.raises(Exception):
        write_colocated(fx.registry(), layout.path)


def test_empty_layout(spark, fx):
    t = {k: v.limit(0) for k, v in fx.registry().items()}
    layout = write_colocated(t, scratch_path(spark, "colo") + "/e")
    assert colocated_view(layout, t).count() == 0


@pytest.fixture(scope="module")
def placed(spark, fx):
    return write_places(fx.registry(), scratch_path(spark, "places") + "/p")


def test_place_search_reads_one_folder(fx, placed):
    t = fx.registry()
    got = search_place(placed, "ring", "am", 50)
    text = plan_of(got)
    assert re.search(r"PartitionFilters: \[.*uf#\d+ = AM", text) and "Join" not in text and exchanges(got) == 0
    assert rows(got) == rows(search_contains(t, "ring", "am", 50))
    assert rows(search_place(placed, "ring", None, 50)) == rows(search_contains(t, "ring", None, 50))
    assert search_place(placed, "ring", "zz").count() == 0
    with_city = search_place(placed, "ring", "am", 100, municipio=3)
    assert "EqualTo(municipio,3)" in plan_of(with_city)


def test_places_are_pruned_at_run_time(spark, placed):
    places = spark.createDataFrame([("AM", 1), ("EU", 0), (None, 1)], "uf string, wanted int").where("wanted = 1")
    got = branches_in(placed, places)
    assert "dynamicpruning" in plan_of(got).lower()
    want = placed.where("uf = 'AM'").groupBy("municipio").count().collect()
    assert {(r["municipio"], r["branches"]) for r in got.collect()} == {(r["municipio"], r["count"]) for r in want}


def test_branches_without_a_place(spark, fx):
    t = fx.registry()
    t["estabelecimento"] = t["estabelecimento"].withColumn("uf", F.when(F.col("uf") != "AM", F.col("uf")))
    path = scratch_path(spark, "places") + "/nulls"
    placed = write_places(t, path)
    assert placed.count() == t["estabelecimento"].count() and search_place(placed, "ring", "am").count() == 0
    assert rows(search_place(read_places(spark, path), "ring", None, 100)) == rows(search_contains(t, "ring", None, 100))
