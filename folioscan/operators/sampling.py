"""Stratified samples with quotas by the square root of size; the order is a hash of the id, so runs agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stratified(rows: DataFrame, by: list[str], row_id: str, n: int, seed: str = "0") -> DataFrame:
    """About n rows, at least one a stratum: quota = max(1, round(n sqrt(size) / sum of sqrt(size))), half to even."""
    sizes = rows.groupBy(*by).agg(F.sqrt(F.count("*")).alias("_root"))
    total = sizes.agg(F.round(F.sum("_root"), 9)).scalar()
    quota = sizes.withColumn("_quota", F.greatest(F.lit(1), F.bround(n * F.col("_root") / total))).select(*by, "_quota")
    order = Window.partitionBy(*by).orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(row_id).cast("string"))), row_id)
    return rows.withColumn("_r", F.row_number().over(order)).join(quota, by).filter(F.col("_r") <= F.col("_quota")).drop("_r", "_quota")
