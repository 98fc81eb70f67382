"""K2, place layout: a copy of the branches in one folder for each uf (F8).

Each row is what a search in one place needs: the branch's key and names, its
company's name, municipality and activity.  A search with a uf reads that folder
only, with no join; a join with a filtered list of places prunes folders at run
time (dynamic partition pruning).  Rows are dealt by ranges of (uf, key), so a
place that holds a third of all branches is written by many tasks to many
files.  In a file rows are in the order of the municipality, and activities have
bloom filters, so that equality on either skips row groups.

A branch without a uf lies in the folder of nulls: no place's search reads it, and one
without a uf reads all folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clamp_limit, contains_pattern, uf_condition
from ..operators.search import DOC_COLUMNS, KEYS3, _doc, _top

PLACED = ["nome_fantasia", "razao_social", "situacao_cadastral", "municipio", "cnae_fiscal_principal", "uf"]
SCHEMA = T.StructType([T.StructField(c, T.LongType() if c in ("situacao_cadastral", "municipio", "cnae_fiscal_principal") else T.StringType())
                       for c in (*KEYS3, *PLACED)])


def write_places(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write the copy and read it back."""
    e = tables["estabelecimento"].select(*KEYS3, "nome_fantasia", "situacao_cadastral", "municipio", "cnae_fiscal_principal", "uf")
    named = e.join(tables["empresa"].select("cnpj_basico", "razao_social"), "cnpj_basico", "left").select(*KEYS3, *PLACED)
    ordered = named.repartitionByRange("uf", *KEYS3).sortWithinPartitions("uf", "municipio", *KEYS3)
    writer = ordered.write.option("parquet.bloom.filter.enabled#cnae_fiscal_principal", "true")
    writer.partitionBy("uf").parquet(path)
    return read_places(e.sparkSession, path)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def search_place(placed: DataFrame, q: str, uf: str | None = None, limit: int = 20, municipio: int | None = None, cnae: int | None = None) -> DataFrame:
    """Q7 over the copy: either name holds ``q``, in one place (all, if none is
    given), and of one municipality or activity, if given; the first by key."""
    pattern = contains_pattern(q)
    rows = placed.where(F.lower("razao_social").like(pattern) | F.lower("nome_fantasia").like(pattern))
    place = uf_condition(uf)
    for only in (place, None if municipio is None else F.col("municipio") == municipio, None if cnae is None else F.col("cnae_fiscal_principal") == cnae):
        rows = rows if only is None else rows.where(only)
    return _doc(_top(rows, clamp_limit(limit))).select(*DOC_COLUMNS)


def branches_in(placed: DataFrame, places: DataFrame, column: str = "uf") -> DataFrame:
    """Branches by municipality of the places that a frame names (their folders only)."""
    wanted = places.select(F.col(column).alias("uf")).where("uf is not null").distinct()
    return placed.join(wanted, "uf", "left_semi").groupBy("uf", "municipio").agg(
        F.count("*").alias("branches"), F.count_if(F.col("situacao_cadastral") == 2).alias("active"))
