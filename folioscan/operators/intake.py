"""What is to be done with each file that waits to be taken in, and every reason why it has to go on waiting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X

# The converters that are known by name.
MANUAL, LAYOUT = "convert_manual", "convert_docling"
# End of fixed values.


def _keys() -> tuple:
    return F.concat("collection", F.lit("/"), "file"), F.col("file")


def decided(waiting: DataFrame, decisions: DataFrame) -> DataFrame:
    """waiting with d, the decision made for a file by collection and name, else by its name alone, and ambiguous: its name alone is decided on but waits in several collections, so that nothing applies."""
    own = decisions.groupBy("key").agg(F.min(F.struct(*[c for c in decisions.columns if c != "key"])).alias("d"))
    full, name = _keys()
    met = waiting.withColumn("_full", full).withColumn("_many", F.count("*").over(Window.partitionBy("file")) > 1)
    met = met.join(own.select(F.col("key").alias("_full"), F.col("d").alias("_exact")), "_full", "left").join(own.select(F.col("key").alias("file"), F.col("d").alias("_named")), "file", "left")
    ambiguous = F.col("_exact").isNull() & F.col("_named").isNotNull() & F.col("_many")
    d = F.when(F.col("_exact").isNotNull(), F.col("_exact")).when(~F.col("_many"), F.col("_named"))
    return met.withColumn("d", d).withColumn("ambiguous", ambiguous).select(*waiting.columns, "d", "ambiguous")


def unused_decisions(waiting: DataFrame, decisions: DataFrame) -> DataFrame:
    """(key): decisions on files that don't wait."""
    full, name = _keys()
    known = waiting.select(F.explode(F.array(full, name)).alias("key")).distinct()
    return decisions.select("key").distinct().join(known, "key", "left_anti")


def plans(waiting: DataFrame, decisions: DataFrame, filed: DataFrame, prose: str | None = None, layout: bool = False) -> DataFrame:
    """(collection, file, shape, title, slug, doc_id, version, converter, held): a file with nothing in `held` is converted.

    waiting: (collection, file, readable, verdict, picked, level, title, slug, doc_id, version, digest); decisions: (key, shape, title, command_level, converter, version, doc_id);
    filed: (collection, slug, doc_id, converter). verdict is reference, prose, mixed, no-toc or no-text; picked and level are the outline levels of entries that converter and assessment found.
    Files that wait together are compared by windows over their manual, slug and content; of two alike the one whose name is first goes on.
    """
    w = decided(waiting, decisions)
    for c in ("title", "version", "doc_id"):
        w = w.withColumn(c, F.coalesce(F.nullif(F.trim(F.col(f"d.{c}")), F.lit("")), F.col(c)))
    w = w.withColumn("shape", F.coalesce(F.col("d.shape"), F.col("verdict")))
    used = filed.groupBy("collection", "doc_id").agg(F.collect_set(F.struct("slug", F.coalesce("converter", F.lit("")).alias("c"))).alias("_used"))
    w = w.join(used, ["collection", "doc_id"], "left").join(filed.select("collection", "slug").distinct().withColumn("_there", F.lit(True)), ["collection", "slug"], "left")
    others = F.array_distinct(F.transform(F.filter(F.coalesce("_used", F.array().cast("array<struct<slug:string,c:string>>")), lambda u: ~u["slug"].eqNullSafe(F.col("slug"))), lambda u: u["c"]))
    as_others = F.when((F.size(others) == 1) & F.get(others, F.lit(0)).isin(MANUAL, LAYOUT), F.get(others, F.lit(0)))
    choice = F.coalesce(F.col("d.converter"), as_others, F.lit(prose), F.lit(LAYOUT if layout else None)).cast("string")
    text = F.col("readable") & (F.col("verdict") != "no-text")
    is_prose, is_reference = text & (F.col("shape") == "prose"), text & (F.col("shape") == "reference")
    w = w.withColumn("_choice", F.when(is_prose, choice)).withColumn("converter", F.when(is_reference, MANUAL).when(is_prose & ((F.col("_choice") != LAYOUT) | F.lit(layout)), F.col("_choice")))
    unsure = F.col("d.command_level").isNull() & F.col("verdict").isin("reference", "mixed") & ~F.col("picked").eqNullSafe(F.col("level"))
    rules = [
        ("unreadable", ~F.col("readable")),
        ("no-text", F.col("readable") & (F.col("verdict") == "no-text")),
        ("no-outline", text & (F.col("shape") == "no-toc")),
        ("mixed-shape", text & (F.col("shape") == "mixed")),
        ("level-unsure", is_reference & unsure),
        ("no-title", F.col("readable") & F.col("title").isNull()),
        ("already-filed", F.col("readable") & F.col("_there")),
        ("no-converter", is_prose & F.col("converter").isNull()),
        ("ambiguous-decision", F.col("ambiguous")),
    ]
    reasons = lambda rs: F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), n) for n, c in rs]))
    # First what a file itself lacks; only files that lack nothing stand in another's way.
    w = w.withColumn("_own", reasons(rules)).withColumn("_free", F.size("_own") == 0)
    release = F.coalesce(F.to_json("_k"), F.nullif(X.norm_version("version"), F.lit("")))
    w = w.withColumn("_k", X.version_key("version")).withColumn("_release", release)
    before = lambda *by: Window.partitionBy("collection", *by).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda cond, *by: F.coalesce(F.bool_or(cond).over(before(*by)), F.lit(False))
    manual = Window.partitionBy("collection", "doc_id")
    free, known = F.col("_free"), F.col("doc_id").isNotNull()
    rival = F.count_if(F.col("_free")).over(manual) - F.when(free, 1).otherwise(0)
    w = w.withColumn("_lacks", known & F.col("_release").isNull() & (rival > 0)).withColumn("_same", known & F.col("_release").isNotNull() & earlier(free, "doc_id", "_release"))
    stays = free & ~F.col("_lacks") & ~F.col("_same")
    w = w.withColumn("_twice", F.col("slug").isNotNull() & ~F.col("_lacks") & ~F.col("_same") & earlier(stays, "slug")).withColumn("_twin", F.col("digest").isNotNull() & earlier(F.lit(True), "digest"))
    more = reasons([("no-version-to-order", F.col("_lacks")), ("same-release-waits", F.col("_same")), ("slug-waits", F.col("_twice")), ("byte-twin-waits", F.col("_twin"))])
    return w.select("collection", "file", "shape", "title", "slug", "doc_id", "version", "converter", F.concat("_own", more).alias("held"))
