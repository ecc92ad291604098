"""Names, callables and SQL of the engine's queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioscan import workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) by its name, with the SQL that gives the same rows."""

    def add(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries are named {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers.find_us(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
