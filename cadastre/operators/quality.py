"""Load quality report: per raw field, how many values were
filled and how many of those did not parse under the declared type — the
values S11 turns into NULL.  One aggregate pass over the raw strings (partial
aggregation, no shuffle of rows), unpacked into one row per field."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import blank_to_null, sanitize_value
from ..schema import TableSpec


def quality_report(raw: DataFrame, fields: list[tuple[str, str]] | TableSpec) -> DataFrame:
    """Rows ``(campo, tipo, rows, filled, invalid)`` for every (column, generic type)."""
    if isinstance(fields, TableSpec):
        fields = list(fields.columns)
    aggs = [F.count("*").alias("_rows")]
    for i, (c, kind) in enumerate(fields):
        filled = blank_to_null(c).isNotNull()
        aggs.append(F.count_if(filled).alias(f"_f{i}"))
        aggs.append(F.count_if(filled & sanitize_value(c, kind).isNull()).alias(f"_x{i}"))
    one = raw.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("campo"),
                F.lit(kind).alias("tipo"),
                F.col("_rows").alias("rows"),
                F.col(f"_f{i}").alias("filled"),
                F.col(f"_x{i}").alias("invalid"),
            )
            for i, (c, kind) in enumerate(fields)
        ]
    )
    return one.select(F.inline(rows))
