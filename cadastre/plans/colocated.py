"""K2, co-located layout: the company-keyed tables as Spark bucketed tables.

``empresa``, ``simples`` and ``estabelecimento`` are written once into the same
number of buckets of the company key, so that J1 and J2 join them bucket by
bucket: no exchange of a big table, only the requests of J2 move.

A bucket is read by one task, so a company that holds more branches than the mean
bucket would make that task the longest.  Such *hot* companies, fewer than there are
buckets whatever the data, go to a table of their own: their branches are spread over
files by the whole key, and their company rows, at most one a bucket in number,
are broadcast to them.  The count that finds them combines on the map side.

The tables are external: their files and a small description lie in one
folder, and any later session attaches them by it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BRANCH_COLUMNS, _profile_columns, registry_columns, small_sides, code_tables, wanted_keys
from .store import Files

KEY, KEYS3 = "cnpj_basico", ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]
#: Bytes of branches that one bucket is to hold, and its rows as the count sees them (a branch row is some 150 bytes).
BUCKET_BYTES, ROW_BYTES = 256 << 20, 150
BUCKETED = ("empresa", "simples", "estabelecimento")
DESCRIPTION = "_layout.json"


@dataclass
class Colocated:
    """Attached tables of one layout."""

    spark: SparkSession
    path: str
    buckets: int
    tables: dict[str, DataFrame]
    hot: DataFrame  # branches of hot companies
    hot_companies: DataFrame  # their empresa and simples columns, fewer rows than buckets
    version: int | None = None


def buckets_for(rows: int) -> int:
    """Buckets for a number of branches: a power of two, 8 at least, so that the layout of a
    grown table can be read by tasks of the old one's multiple."""
    want = max(8, -(-rows * ROW_BYTES // BUCKET_BYTES))
    return 1 << (want - 1).bit_length()


def write_colocated(tables: dict[str, DataFrame], path: str, buckets: int | None = None, version: int | None = None) -> Colocated:
    """Write the layout under a new folder ``path`` and attach it."""
    spark = tables["estabelecimento"].sparkSession
    path = path.rstrip("/")
    e, emp, s = (tables[t] for t in ("estabelecimento", "empresa", "simples"))
    each = e.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("*").alias("n"))
    each.write.parquet(f"{path}/branches_of")  # counted once; read twice below
    each = spark.read.parquet(f"{path}/branches_of")
    total = each.agg(F.sum("n")).first()[0] or 0
    buckets = buckets or buckets_for(total)
    # more than the mean of a bucket: fewer than `buckets` companies can hold that
    keys = F.broadcast(each.where(F.col("n") * buckets > total).select(KEY))
    company = emp.join(keys, KEY, "left_semi").join(s.join(keys, KEY, "left_semi"), KEY, "full_outer")
    company.coalesce(1).write.parquet(f"{path}/hot_companies")
    hot = e.join(keys, KEY, "left_semi")
    hot.repartitionByRange(*KEYS3).sortWithinPartitions(*KEYS3).write.parquet(f"{path}/hot")
    own = {"empresa": emp, "simples": s, "estabelecimento": e.join(keys, KEY, "left_anti")}
    name = uuid.uuid4().hex[:12]
    for t in BUCKETED:
        # one task a bucket writes one file, in the order of the key
        rows = own[t].repartition(buckets, KEY)
        writer = rows.write.bucketBy(buckets, KEY).sortBy(KEY).format("parquet").option("path", f"{path}/{t}")
        writer.saveAsTable(_table(t, name))
        spark.sql(f"DROP TABLE {_table(t, name)}")  # external: the files stay
    described = {"buckets": buckets, "version": version,
                 "schemas": {t: own[t].schema.json() for t in BUCKETED} | {"hot": hot.schema.json(), "hot_companies": company.schema.json()}}
    if not Files(spark, path).create(DESCRIPTION, json.dumps(described)):
        raise FileExistsError(f"{path} holds a layout already")
    return attach(spark, path)


def _table(name: str, of: str) -> str:
    return f"cadastre_{of}_{name}"


def attach(spark: SparkSession, path: str) -> Colocated:
    """The layout in a folder, as this session's tables (nothing is read)."""
    from pyspark.sql import types as T

    path = path.rstrip("/")
    described = json.loads(Files(spark, path).read(DESCRIPTION))
    schema = {t: T.StructType.fromJson(json.loads(j)) for t, j in described["schemas"].items()}
    name, tables = uuid.uuid4().hex[:12], {}
    for t in BUCKETED:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema[t])
        spark.sql(f"CREATE TABLE {_table(t, name)} ({columns}) USING parquet LOCATION '{path}/{t}' "
                  f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {described['buckets']} BUCKETS")
        tables[t] = spark.table(_table(t, name))
    return Colocated(spark, path, described["buckets"], tables, spark.read.schema(schema["hot"]).parquet(f"{path}/hot"),
                     spark.read.schema(schema["hot_companies"]).parquet(f"{path}/hot_companies"), described["version"])


def colocated_view(layout: Colocated, codes: dict[str, DataFrame]) -> DataFrame:
    """J1 over the layout: bucket joins without an exchange, and the branches of
    hot companies beside their broadcast company rows."""
    t = layout.tables
    emp, s = t["empresa"].select(KEY, "razao_social", "natureza_juridica"), t["simples"].select(KEY, "opcao_pelo_simples", "opcao_mei")
    cold = t["estabelecimento"].join(emp.hint("merge"), KEY, "left").join(s.hint("merge"), KEY, "left")
    few = F.broadcast(layout.hot_companies.select(KEY, "razao_social", "natureza_juridica", "opcao_pelo_simples", "opcao_mei"))
    sides = small_sides(code_tables(codes))
    hot = layout.hot.join(few, KEY, "left")
    return registry_columns(cold, sides).unionByName(registry_columns(hot, sides))


def colocated_profiles(layout: Colocated, requests: DataFrame, column: str = "requested") -> DataFrame:
    """J2 (bulk) over the layout: the requests move to the buckets once, the
    tables stay where they are.  Requests of hot companies do not move at all:
    they meet the broadcast company rows, and then the hot branches."""
    w = wanted_keys(requests, column)
    names = ["requested", "cnpj_clean", "is_valid"]
    t, hot_rows = layout.tables, layout.hot_companies
    of = F.broadcast(hot_rows.select(KEY, "razao_social", "opcao_pelo_simples", "opcao_mei", F.lit(True).alias("_hot")))
    tagged = w.where("is_valid").join(of, KEY, "left")
    hot = tagged.where("_hot").join(layout.hot.select(*KEYS3, *BRANCH_COLUMNS, F.lit(True).alias("_branch")), KEYS3, "left")
    rest = tagged.where("_hot is null").select(*names, *KEYS3)
    emp, s = t["empresa"].select(KEY, "razao_social"), t["simples"].select(KEY, "opcao_pelo_simples", "opcao_mei")
    e = t["estabelecimento"].select(*KEYS3, *BRANCH_COLUMNS, F.lit(True).alias("_branch"))
    rest = rest.join(emp.hint("merge"), KEY, "left").join(s.hint("merge"), KEY, "left").join(e.hint("merge"), KEYS3, "left")

    def shown(rows: DataFrame) -> DataFrame:
        found = F.col("_branch").isNotNull()
        made = rows.select(*names, found.alias("found"), F.struct(*_profile_columns()).alias("_p"))
        fields = [f.name for f in made.schema["_p"].dataType]
        return made.select(*names, *[F.when(F.col("found"), F.col(f"_p.{f}")).alias(f) for f in fields], "found")

    good = shown(rest).unionByName(shown(hot))
    bad = w.where("not is_valid or is_valid is null").select(
        *names, *[F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema if f.name not in (*names, "found")], F.lit(False).alias("found"))
    return good.unionByName(bad)
