"""Registration of the checkable queries: key → (Spark callable, DuckDB SQL).

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame that
reads the driver's tables (or data Spark derives from them); the SQL is the
independent DuckDB oracle over the same parquet views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn: Callable[[Fixtures], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Fixtures(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn

    return deco
