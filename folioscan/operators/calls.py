"""Analytics of call logs: summaries by tool, repeated searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X

from .evaluate import floor_percentile


#: Bins of values per doubling: a bin holds few different values, and there are some thousand bins however many calls.
BINS = 1024


def quantiles(counted: DataFrame, by: str, value: str, wanted: dict[str, Column]) -> DataFrame:
    """(by, names): the values at places (from 0) of the sorted values of each group; counted (by, value, k) has every value once, with its count.

    Counts of bins say which bin holds a place; only that bin's values are ordered. No group is ordered or gathered as a whole.
    """
    v = F.col(value)
    binned = counted.filter(v.isNotNull()).withColumn("_bin", F.floor(F.signum(v) * F.log2(F.abs(v) + 1) * BINS).cast("long"))
    before = lambda *order: Window.partitionBy(*order[:-1]).orderBy(order[-1]).rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy(by, "_bin").agg(F.sum("k").alias("_k"))
    total = bins.groupBy(by).agg(F.sum("_k").alias("n"))
    placed = bins.withColumn("_before", F.coalesce(F.sum("_k").over(before(by, "_bin")), F.lit(0)))
    places = total.select(by, F.inline(F.array(*[F.struct(F.lit(name).alias("_name"), at.cast("long").alias("_at")) for name, at in wanted.items()])))
    found = placed.join(places, by).filter((F.col("_before") <= F.col("_at")) & (F.col("_at") < F.col("_before") + F.col("_k"))).select(by, "_bin", "_name", (F.col("_at") - F.col("_before")).alias("_at"))
    within = binned.join(found.select(by, "_bin").distinct(), [by, "_bin"], "left_semi")
    within = within.withColumn("_before", F.coalesce(F.sum("k").over(before(by, "_bin", value)), F.lit(0)))
    hit = within.join(found, [by, "_bin"]).filter((F.col("_before") <= F.col("_at")) & (F.col("_at") < F.col("_before") + F.col("k")))
    return hit.groupBy(by).agg(*[F.max(F.when(F.col("_name") == name, v)).alias(name) for name in wanted])


def summary(calls: DataFrame, by: str = "tool") -> DataFrame:
    """(tool, calls, errors, median_ms, p95_ms, mean_ms): the 95th percentile is the element at floor(0.95 (n - 1))."""
    counted = calls.groupBy(by, "ms").agg(F.count("*").alias("k"), F.count_if("error").alias("e"))
    known = F.when(F.col("ms").isNotNull(), F.col("k")).otherwise(0)
    sums = counted.groupBy(by).agg(F.sum("k").alias("calls"), F.sum("e").alias("errors"), (F.sum(F.col("ms") * F.col("k")) / F.nullif(F.sum(known), F.lit(0))).alias("mean"))
    n = F.col("n")
    found = quantiles(counted, by, "ms", {"low": F.floor((n - 1) / 2), "high": F.floor(n / 2), "p95_ms": F.floor(F.lit(0.95) * (n - 1))})
    out = sums.join(found, by, "left")
    return out.select(by, "calls", "errors", F.round((F.col("low") + F.col("high")) / 2, 6).alias("median_ms"), F.col("p95_ms").cast("double").alias("p95_ms"), F.round("mean", 6).alias("mean_ms"))


def groups(calls: DataFrame, query: str, scope: list[str], order: str) -> DataFrame:
    """(key, scope, n, last, first_at): searches alike but for case and blanks; the latest stands for them."""
    key = F.lower(X.collapse(query)).alias("key")
    return calls.groupBy(key, *scope).agg(F.count("*").alias("n"), F.max_by(query, order).alias("last"), F.min(order).alias("first_at"))


__all__ = ["floor_percentile", "groups", "summary"]
