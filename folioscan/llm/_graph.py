"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import stage

#: Far more rounds than any graph needs (they grow with the logarithm of its size); a guard against a bug.
MOST_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u, linked to the least of u and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours, linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    own = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return own.union(least.select("a", F.col("m").alias("b")))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node of its component.

    Each round is written to the shared folder, so lineage stays short; a hub's edges meet only partial
    minima and joins that Spark can split. Nodes without an edge, and edges from a node to itself, don't appear.
    """
    now = stage(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(MOST_ROUNDS):
        now = stage(spark, _small(_large(now)).distinct(), "edges")
        r = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (r[0], r[1]) == mark:
            break
        mark = (r[0], r[1])
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
