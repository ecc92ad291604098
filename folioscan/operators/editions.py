"""Releases of documents: order, what is current, which one answers for a release, what can't be decided."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("version_key", X.version_key("version"))


def problems(docs: DataFrame) -> DataFrame:
    """(collection, doc_id, problem, version): several editions of which one has no order, or two have the same."""
    k = keyed(docs).select("collection", "doc_id", "slug", "version", "version_key")
    per = k.groupBy("collection", "doc_id").agg(F.count("*").alias("n"), F.count_if(F.col("version_key").isNull()).alias("lost"))
    unordered = per.filter("n > 1 and lost > 0").select("collection", "doc_id", F.lit("edition-unordered").alias("problem"), F.lit(None).cast("string").alias("version"))
    twice = k.filter("version_key is not null").groupBy("collection", "doc_id", "version_key").agg(F.count("*").alias("n"), F.min("version").alias("version")).filter("n > 1")
    return unordered.unionByName(twice.select("collection", "doc_id", F.lit("edition-duplicate-version").alias("problem"), "version"))


def resolved(docs: DataFrame, pins: DataFrame | None = None) -> DataFrame:
    """docs with is_latest and is_current. What can't be decided is null, never guessed.

    pins (collection, doc_id, version) make an edition of that release current.
    """
    k = keyed(docs)
    w = Window.partitionBy("collection", "doc_id")
    n, known = F.count("*").over(w), F.count("version_key").over(w)
    top = F.max("version_key").over(w)
    tied = F.count_if(F.col("_top")).over(w)
    k = k.withColumn("_n", n).withColumn("_known", known).withColumn("_top", F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.coalesce(F.col("version_key") == top, F.lit(False))))
    sure = (F.col("_n") == 1) | (F.col("_known") == F.col("_n"))
    k = k.withColumn("_tied", tied).withColumn("is_latest", F.when(sure & (F.col("_tied") == 1), F.col("_top")))
    if pins is None:
        return k.withColumn("is_current", F.col("is_latest")).drop("_n", "_known", "_top", "_tied")
    pin = pins.select("collection", "doc_id", X.version_key("version").alias("_pin"))
    k = k.join(pin, ["collection", "doc_id"], "left")
    return k.withColumn("is_current", F.when(F.col("_pin").isNotNull(), F.coalesce(F.col("version_key") == F.col("_pin"), F.lit(False))).otherwise(F.col("is_latest"))).drop("_n", "_known", "_top", "_tied", "_pin")


def as_of(requests: DataFrame, docs: DataFrame) -> DataFrame:
    """requests (request, collection, doc_id, version) with the edition that answers: the release itself, by its name or its numbers, else the nearest earlier one that says "and later"; else none, with the reason.

    Only the best edition of a request matters, so the join is followed by partial minima and maxima: no sort of all pairs.
    """
    wanted = requests.select("request", "collection", "doc_id", X.norm_version("version").alias("_name"), X.version_key("version").alias("_wanted"))
    own = keyed(docs).select("collection", "doc_id", "slug", X.norm_version("version").alias("_own"), "version_key", "version_later")
    met = wanted.join(own, ["collection", "doc_id"])
    same = (F.col("_own") != "") & ((F.col("_own") == F.col("_name")) | F.coalesce(F.col("version_key") == F.col("_wanted"), F.lit(False)))
    exact = F.min(F.when(same, F.struct(F.col("version_key").isNotNull().alias("known"), "version_key", "slug")))
    earlier = F.max(F.when(F.col("version_key") < F.col("_wanted"), F.struct("version_key", "slug", F.coalesce("version_later", F.lit(False)).alias("later"))))
    best = met.groupBy("request").agg(exact.alias("e"), earlier.alias("b"))
    out = requests.join(best, "request", "left")
    how = F.when(F.col("e").isNotNull(), "exact").when(F.col("b.later"), "earlier, and later").when(F.col("b").isNotNull(), "not covered").otherwise("no edition")
    slug = F.when(F.col("e").isNotNull(), F.col("e.slug")).when(F.col("b.later"), F.col("b.slug"))
    return out.select(*requests.columns, slug.alias("slug"), how.alias("how"))


def clashes(folders: DataFrame) -> DataFrame:
    """Collection keys that several folders share: (collection, n_folders, folders)."""
    keys = folders.select(F.col("folder"), X.slug("folder", default="corpus").alias("collection")).distinct()
    return keys.groupBy("collection").agg(F.count("*").alias("n_folders"), F.array_join(F.sort_array(F.collect_list("folder")), "|").alias("folders")).filter("n_folders > 1")


def ungrouped(docs: DataFrame) -> DataFrame:
    """Titles that stand under several document ids: perhaps editions of one manual."""
    return docs.groupBy("collection", X.title_key("title").alias("title_key")).agg(F.count_distinct("doc_id").alias("n_ids")).filter("n_ids > 1")


def byte_twins(files: DataFrame) -> DataFrame:
    """files (name, content) of the same size and SHA-256: (sha256, n, first_name). Sizes are compared before contents are hashed."""
    sized = files.select("name", F.octet_length("content").alias("size"), F.sha2("content", 256).alias("sha256"))
    return sized.groupBy("size", "sha256").agg(F.count("*").alias("n"), F.min("name").alias("first_name")).filter("n > 1").select("sha256", "size", "n", "first_name")


def staleness(recorded: DataFrame, current: DataFrame, key: str = "path") -> DataFrame:
    """Sources that were recorded and are gone, are new, or changed in size or content."""
    a = recorded.select(key, F.col("size").alias("size_a"), F.col("sha256").alias("sha_a"), F.lit(1).alias("_a"))
    b = current.select(key, F.col("size").alias("size_b"), F.col("sha256").alias("sha_b"), F.lit(1).alias("_b"))
    state = F.when(F.col("_b").isNull(), "gone").when(F.col("_a").isNull(), "new").when(~F.col("size_a").eqNullSafe(F.col("size_b")), "size").when(~F.col("sha_a").eqNullSafe(F.col("sha_b")), "content").otherwise("same")
    return a.join(b, key, "full_outer").select(key, state.alias("state")).filter("state <> 'same'")
