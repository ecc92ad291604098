"""The tables of an index, from manifests and chunks: documents with counts, coverage, catalog lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DOC = ["collection", "slug"]


def document_stats(documents: DataFrame, chunks: DataFrame, figures: DataFrame | None = None) -> DataFrame:
    """documents with section_count, indexed_count, char_count, has_pages, has_entities and figure_count."""
    per = chunks.groupBy(*DOC).agg(F.count("*").alias("section_count"), F.count("body").alias("indexed_count"), F.sum(F.length("body")).alias("char_count"), F.bool_or(F.col("page_start").isNotNull()).alias("has_pages"), F.bool_or(F.col("entity").isNotNull()).alias("has_entities"))
    out = documents.join(per, DOC, "left").fillna(0, ["section_count", "indexed_count", "char_count"]).fillna(False, ["has_pages", "has_entities"])
    if figures is None:
        return out.withColumn("figure_count", F.lit(0).cast("long"))
    return out.join(figures.groupBy(*DOC).agg(F.count("id").alias("figure_count")), DOC, "left").fillna(0, ["figure_count"])


def coverage_gap(documents: DataFrame, most: int = 4) -> DataFrame:
    """The documents with most sections missing from the index, and the sums over all beside them."""
    gap = documents.withColumn("gap", F.col("section_count") - F.col("indexed_count"))
    sums = documents.agg(F.sum("section_count").alias("s"), F.sum("indexed_count").alias("i")).select(F.struct("s", "i"))
    worst = gap.filter("gap > 0").orderBy(F.desc("gap"), *DOC).limit(most)
    return worst.withColumn("_all", sums.scalar()).select(*DOC, "gap", F.col("_all.s").alias("all_sections"), F.col("_all.i").alias("all_indexed"))


def listing(documents: DataFrame) -> DataFrame:
    """documents with the number of editions of their manual."""
    return documents.withColumn("n_editions", F.count("*").over(Window.partitionBy("collection", "doc_id")))


def command_level(toc: DataFrame, doc: list[str], least: int = 20) -> DataFrame:
    """(doc, level, n): the level with most titles like identifiers, if there are enough; of equal ones the first seen."""
    shaped = toc.filter(F.col("title").rlike(r"^[A-Za-z]\w*_\w+$"))
    per = shaped.groupBy(*doc, "level").agg(F.count("*").alias("n"), F.min("idx").alias("first"))
    best = per.groupBy(*doc).agg(F.max(F.struct("n", (-F.col("first")).alias("f"), "level")).alias("b"))
    return best.filter(F.col("b.n") >= least).select(*doc, F.col("b.level").alias("level"), F.col("b.n").alias("n"))


def shape(toc: DataFrame, pages: DataFrame, doc: list[str], least: int = 20, share: float = 0.30, prose: float = 0.10, mixed: float = 0.15) -> DataFrame:
    """(doc, shape): reference, mixed or prose, by entry-like titles of one level and their density on pages (doc, n_pages)."""
    entry = F.col("title").rlike(r"^[A-Za-z][\w.:-]*$") & (F.length("title") > 2)
    per = toc.groupBy(*doc, "level").agg(F.count("*").alias("n_all"), F.count_if(entry).alias("n"))
    best = per.filter((F.col("n") >= least) & (F.col("n") >= share * F.col("n_all"))).groupBy(*doc).agg(F.max("n").alias("n"))
    density = F.col("n") / F.greatest("n_pages", F.lit(1))
    return pages.join(best, doc, "left").select(*doc, F.when(F.col("n").isNull() | (density < prose), "prose").when(density < mixed, "mixed").otherwise("reference").alias("shape"))


def chunk_totals(chunks: DataFrame) -> DataFrame:
    """(collection, slug, n, level): chunks a document (level 0), a collection (1) and in all (3), in one pass; names above a row's level are null."""
    return chunks.rollup(*DOC).agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level")).select(*DOC, "n", "level")


def report_lines(rows: DataFrame, widths: dict[str, int], order: str, totals: list[str] = ()) -> DataFrame:
    """(n, line): a report of fixed width, a line a row, numbers to the right; the last line has the sums of `totals`. Longer values stay whole."""
    kinds = dict(rows.dtypes)
    number = {c: kinds[c] not in ("string", "boolean") for c in widths}

    def cell(c: str, v):
        s = F.coalesce(v.cast("string"), F.lit("-"))
        pad = F.repeat(F.lit(" "), F.greatest(F.lit(widths[c]) - F.length(s), F.lit(0)))
        return F.concat(pad, s) if number[c] else F.concat(s, pad)

    def line(values) -> object:
        return F.rtrim(F.concat_ws("  ", *[cell(c, values(c)) for c in widths]))

    body = rows.select(F.col(order).cast("long").alias("n"), line(F.col).alias("line"))
    if not totals:
        return body
    sums = rows.agg(*[F.sum(c).alias(c) for c in totals], F.max(F.col(order).cast("long")).alias("_n"))
    first = next(iter(widths))
    last = sums.select((F.coalesce("_n", F.lit(0)) + 1).alias("n"), line(lambda c: F.coalesce(F.col(c), F.lit(0)) if c in totals else F.lit("total" if c == first else "")).alias("line"))
    return body.union(last)
