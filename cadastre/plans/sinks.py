"""Sinks and layout: K1 write_tables (see ``store``), K2 layout_after_load,
K5 index_export, K6 bulk_tsv_export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import bulk_tsv_value
from ..schema import TableSpec

EXPORT_BATCH = 1000

# Search-engine settings of the exported documents.
INDEX_SETTINGS = {"primary_key": "cnpj", "searchable": ["razao_social", "nome_fantasia"], "filterable": ["uf", "cnae"]}


def layout(
    df: DataFrame,
    path: str,
    keys: list[str],
    partition_by: list[str] | None = None,
    bloom: list[str] | None = None,
    files: int | None = None,
) -> None:
    """K2: rewrite ``df`` range-partitioned and sorted by ``keys`` so every file
    covers a disjoint key range (parquet min/max statistics skip files for
    point lookups such as J2/Q4); optional ``partition_by`` folders (e.g. uf)
    and parquet bloom filters on equality columns (cnae, municipio)."""
    out = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    out = out.sortWithinPartitions(*keys)
    w = out.write.mode("overwrite")
    for c in bloom or []:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def file_ranges(spark, path: str, key: str) -> DataFrame:
    """Per written file: row count and key range (to check K2's disjoint ranges)."""
    df = spark.read.parquet(path)
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count("*").alias("rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key")
    )


def export_index(docs: DataFrame, path: str, batch: int = EXPORT_BATCH, compression: str = "none") -> None:
    """K5: full re-export of the search documents as JSON lines, one document
    per ``cnpj`` (the key of the state they come from, so already unique).
    Files are as large as Spark's partitions, whatever the batch; the settings
    name the number of lines that a client sends at a time."""
    spark = docs.sparkSession
    docs.write.mode("overwrite").option("compression", compression).json(f"{path}/documents")
    settings = spark.createDataFrame(
        [(INDEX_SETTINGS["primary_key"], INDEX_SETTINGS["searchable"], INDEX_SETTINGS["filterable"], batch)],
        "primary_key string, searchable array<string>, filterable array<string>, batch int",
    )
    settings.coalesce(1).write.mode("overwrite").json(f"{path}/settings")


def bulk_tsv(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """F11 over every declared column of raw text, joined by tabs (one ``value`` column)."""
    return raw.select(F.concat_ws("\t", *[bulk_tsv_value(c, k) for c, k in spec.columns]).alias("value"))


def export_tsv(raw: DataFrame, spec: TableSpec, path: str) -> None:
    """K6: bulk-load text files (tab separated, ``\\n`` rows, ``\\N`` for NULL)."""
    bulk_tsv(raw, spec).write.mode("overwrite").option("lineSep", "\n").text(path)
