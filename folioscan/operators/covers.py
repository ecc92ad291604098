"""What the first pages and the outline of a document say of it: release, title, how it will convert; and figures that are page furniture."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import labels as N
from folioscan.functions import text as X

# Pages that are a cover, a sampled document, the share that makes a running title, characters of a page with text, repeats that are furniture.
COVER_PAGES, SAMPLE, RUNNING_SHARE, TEXT_CHARS, TEXT_SAMPLE, REPEATS, REPEAT_SHARE = 3, 40, 0.30, 100, 10, 5, 0.05
LETTERED = r"\b[A-Z]-20[0-9]{2}\.[0-9]{2}(?:-SP[0-9]+(?:-[0-9]+)?)?\b"
LABELLED = r"(?i)\b(?:software\s+version|version|release)\s+v?(20[0-9]{2}\.[0-9]{1,2}(?:\.[0-9]+)*(?:-SP[0-9]+(?:-[0-9]+)?)?)"
# End of fixed values.


def covers(pages: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, version, later, found, note): the release that the first pages name, if they name one and the file's name doesn't say another. pages: (doc, page, text, file)."""
    first = pages.filter(F.col("page") <= COVER_PAGES).groupBy(*doc).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "text"))), lambda x: x.text), "\n").alias("_t"), F.max("file").alias("_f"))
    lettered, labelled = F.regexp_extract_all("_t", F.lit(LETTERED), F.lit(0)), F.regexp_extract_all("_t", F.lit(LABELLED), F.lit(1))
    # In reading order: the place of a hit is where its text first stands.
    hits = F.array_sort(F.transform(F.array_distinct(F.concat(lettered, labelled)), lambda v: F.struct(F.instr(F.col("_t"), v).alias("at"), v.alias("v"))))
    own = first.withColumn("_h", hits).withColumn("found", F.get("_h", F.lit(0))["v"])
    own = own.withColumn("_keys", F.array_distinct(F.transform("_h", lambda h: F.coalesce(X.version_key(h["v"]), F.array().cast("array<bigint>"))))).withColumn("_named", X.filename_version("_f"))
    own = own.withColumn("_kn", X.version_key("_named")).withColumn("_kf", X.version_key("found"))
    later = F.coalesce(F.exists("_h", lambda h: F.substring(F.col("_t"), h["at"] + F.length(h["v"]), F.lit(20)).rlike(r"(?i)^\s*(?:\+|and\s+later)")), F.lit(False))
    clash = F.col("_named").isNotNull() & ~N.filename_agrees("_named", "found", "_kn", "_kf") & ~(later & F.coalesce(F.col("_kn") > F.col("_kf"), F.lit(False)))
    note = F.when(F.col("found").isNull(), "no version on the first pages").when(F.size("_keys") > 1, "the first pages name more than one version").when(clash, "the cover and the file name disagree").otherwise("")
    out = own.withColumn("note", note).withColumn("_later", later)
    return out.select(*doc, F.when(F.col("note") == "", F.col("found")).alias("version"), F.when((F.col("note") == "") | F.col("note").startswith("the cover and"), F.col("_later")).otherwise(False).alias("later"), "found", "note")


def running_share(pages: DataFrame, titles: DataFrame, doc: list[str], sample: int | None = SAMPLE) -> DataFrame:
    """(doc, share, accepted): on how many of an even sample of pages after the first the title is a line, but for versions and page numbers beside it."""
    n = Window.partitionBy(*doc)
    later = pages if sample is None else pages.filter("page > 1").withColumn("_n", F.count("*").over(n)).withColumn("_r", F.row_number().over(n.orderBy("page")) - 1)
    if sample is not None:
        step = F.greatest(F.lit(1), F.floor(F.col("_n") / sample))
        later = later.filter((F.col("_r") % step == 0) & (F.col("_r") / step < sample))
    words = lambda t: F.array_join(X.ascii_words(t), " ")
    dotted = lambda t: N.title_core(F.regexp_replace(F.lower(t), r"\b\d+(?:\.\d+)+\b", "0"))
    met = later.join(titles.select(*doc, words(dotted("title")).alias("_t")), doc)
    hit = F.exists(X.lines("text"), lambda line: words(dotted(line)) == F.col("_t"))
    share = F.avg(F.when(hit & (F.col("_t") != ""), 1.0).otherwise(0.0))
    return met.groupBy(*doc).agg(F.round(share, 6).alias("share"), (share >= RUNNING_SHARE).alias("accepted"))


def preflight(toc: DataFrame, pages: DataFrame, sizes: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, density, shared, anchoring, fallback, has_text): entries a page, the share of starting pages with several, and whether ten evenly spaced pages have text. sizes: (doc, n_pages)."""
    starts = toc.groupBy(*doc, "page").agg(F.count("*").alias("n"))
    per = starts.groupBy(*doc).agg(F.sum("n").alias("_toc"), F.avg(F.when(F.col("n") >= 2, 1.0).otherwise(0.0)).alias("_shared"))
    step = F.greatest(F.lit(1), F.floor(F.col("n_pages") / TEXT_SAMPLE))
    some = pages.join(sizes, doc).filter((F.col("page") % step == 0) & (F.col("page") / step < TEXT_SAMPLE))
    text = some.groupBy(*doc).agg((F.floor(F.avg(F.length(F.trim("text")))) >= TEXT_CHARS).alias("has_text"))
    met = sizes.join(per, doc, "left").join(text, doc, "left")
    density = F.coalesce("_toc", F.lit(0)) / F.greatest("n_pages", F.lit(1))
    return met.select(*doc, F.round(density, 6).alias("density"), F.round(F.coalesce("_shared", F.lit(0.0)), 6).alias("shared"), N.anchoring_band(density).alias("anchoring"), N.fallback_band(F.coalesce("_shared", F.lit(0.0))).alias("fallback"), F.coalesce("has_text", F.lit(False)).alias("has_text"))


def without_repeated(figures: DataFrame, sizes: DataFrame, doc: list[str]) -> DataFrame:
    """figures (doc, bbox, fingerprint, caption) without those that have no caption and stand with the same art in the same place on many pages. sizes: (doc, n_pages)."""
    spot = F.transform("bbox", lambda v: F.round(v / 4))
    own = figures.withColumn("_spot", spot)
    counts = own.groupBy(*doc, "_spot", "fingerprint").agg(F.count("*").alias("_n"))
    met = own.join(counts, [*doc, "_spot", "fingerprint"], "left").join(sizes, doc, "left")
    often = F.col("_n") >= F.greatest(F.lit(REPEATS), REPEAT_SHARE * F.col("n_pages"))
    return met.filter((F.coalesce("caption", F.lit("")) != "") | ~F.coalesce(often, F.lit(False))).drop("_spot", "_n", "n_pages")


def gate(old: DataFrame, new: DataFrame) -> DataFrame:
    """(replaces, …): a new index replaces the old one only if neither hit@5 nor the mean reciprocal rank of all questions falls. Both are tables of hit rates."""
    a, b = (df.filter("kind = 'all'").select(F.col("hit_5").alias(f"hit_5_{s}"), F.col("mrr").alias(f"mrr_{s}")) for df, s in ((old, "old"), (new, "new")))
    return a.crossJoin(b).withColumn("replaces", (F.col("hit_5_new") >= F.col("hit_5_old")) & (F.col("mrr_new") >= F.col("mrr_old")))
