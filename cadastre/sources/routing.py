"""S9 route_files: file name → table, first declared marker contained in the
upper-cased base name wins (declared table order matters; folders never route)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TABLES


def base_name(path) -> Column:
    return F.regexp_extract(F.col(path) if isinstance(path, str) else path, r"([^/]*)$", 1)


def route_column(name) -> Column:
    up = F.upper(base_name(name))
    expr = None
    for spec in TABLES.values():
        for marker in spec.markers:
            cond = up.contains(marker)
            expr = F.when(cond, F.lit(spec.name)) if expr is None else expr.when(cond, F.lit(spec.name))
    return expr.otherwise(F.lit(None).cast("string"))


def route_files(df: DataFrame, name_col: str) -> DataFrame:
    return df.withColumn("table", route_column(name_col))
