"""The index of a corpus: what a search needs, built once. Postings are dealt out and sorted by term, so that a query's few terms prune what is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X
from folioscan.functions.udfs import stem_term

from . import catalog_tables, lookup, search

KEY = ["collection", "slug", "ord"]
#: Postings a partition holds.
PART = 4_000_000
#: Characters of text whose postings one task counts.
CHARS = 8_000_000


def postings(docs: DataFrame, key: list[str], fields: dict[str, float], parts: int | None = None) -> dict[str, DataFrame]:
    """postings (term, key, n_tokens, f), lengths (key, n_tokens), and terms (term, df, cf, stem) without which no query term is met."""
    # Texts are dealt out by document first, so that the rows of their words need not be to be counted; then each posting moves once, to its term's partition.
    chars = docs.agg(F.sum(sum((F.coalesce(F.length(F.col(f)), F.lit(0)) for f in fields), F.lit(0)).cast("long"))).first()[0] or 0
    dealt = docs.select(*key, *[f for f in fields if f not in key]).repartition(max(docs.sparkSession.sparkContext.defaultParallelism, -(-chars // CHARS)), *key)
    flat = search.postings(dealt, key, fields)
    flat = flat.repartition(parts, "term") if parts else flat.repartition("term")
    return {"postings": flat.sortWithinPartitions("term", *key).select("term", *key, "n_tokens", "f"), "lengths": search.lengths(docs, key, fields).select(*key, "n_tokens")}


def terms(postings_: DataFrame) -> DataFrame:
    """(term, df, cf, stem): distinct terms are few, so they are stemmed once each."""
    return postings_.groupBy("term").agg(F.count("*").alias("df"), F.sum("f").alias("cf")).withColumn("stem", stem_term("term"))


def tables(documents: DataFrame, chunks: DataFrame, figures: DataFrame, sources: DataFrame, versions: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All tables of an index, from documents (collection, slug, doc_id, version, title, toc, …), chunks (collection, slug, ord, file, heading, entity, breadcrumb, body, pages, chars, noise),
    figures (collection, slug, id, section, caption, labels, ocr, description, …) and sources."""
    text = F.concat_ws(" ", *[F.nullif(F.trim(c), F.lit("")) for c in ("caption", "labels", "ocr", "description")])
    said = figures.filter("section is not null").groupBy("collection", "slug", F.col("section").alias("file")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", text.alias("t")))), lambda x: x.t), " ").alias("figures"))
    own = chunks.filter("body is not null").join(said, ["collection", "slug", "file"], "left").withColumn("figures", F.coalesce("figures", F.lit("")))
    own = own.withColumn("chunk_id", F.row_number().over(Window.orderBy(*KEY)).cast("long")) if versions is None else own.withColumn("chunk_id", F.xxhash64(*KEY))
    stats = catalog_tables.document_stats(documents, chunks, figures)
    found = postings(own, KEY, search.WEIGHTS)
    idents = own.select(*KEY, F.explode(F.array_distinct(F.concat(X.identifiers("heading"), X.identifiers("body")))).alias("ident"))
    counts = own.agg(F.count("*").alias("chunks")).crossJoin(documents.agg(F.count("*").alias("documents"))).crossJoin(figures.agg(F.count("id").alias("figures")))
    meta = counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in ("chunks", "documents", "figures")])).alias("m")).select("m.*")
    return {"documents": stats, "chunks": own, "entities": lookup.entities(own, ["collection", "slug"]), "figures": figures, "sources": sources, "idents": idents, "meta": meta, **found}


def health(meta: DataFrame, documents: DataFrame) -> DataFrame:
    """(status, documents, chunks, figures): degraded where sections are missing from the index."""
    wide = meta.groupBy().pivot("key", ["chunks", "documents", "figures"]).agg(F.first("value").cast("long"))
    gap = documents.agg(F.coalesce(F.sum(F.col("section_count") - F.col("indexed_count")), F.lit(0)).alias("gap"))
    return wide.crossJoin(gap).select(F.when(F.col("gap") > 0, "degraded").otherwise("ok").alias("status"), "documents", "chunks", "figures")


def stats_listing(chunks: DataFrame) -> DataFrame:
    """Chunks of each document, and of all as nulls."""
    return chunks.rollup("collection", "slug").agg(F.count("*").alias("chunks")).filter(F.col("slug").isNotNull() | F.col("collection").isNull())
