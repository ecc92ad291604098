"""The tools of a corpus as one surface: each takes the tables of an index (see index.tables) and a table of requests, and gives a table of answers with `request`.

A request that can't be answered has an answer too: its `error` says why. Batches are one plan each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import labels as N
from folioscan.functions import text as X

from . import catalog_tables, compare, editions, lookup, passages, script_lint, search

Tables = dict[str, DataFrame]
#: Levels of an outline that are shown unless a part of a title is asked for.
TOC_LEVELS = 2


def _scoped(requests: DataFrame, tables: Tables) -> DataFrame:
    """requests with the edition that their document and version mean: slug, how."""
    asked = requests.filter("coalesce(document, '') <> ''").select("request", "collection", F.col("document").alias("doc_id"), "version")
    docs = tables["documents"]
    by_slug = asked.join(docs.select("collection", F.col("slug").alias("doc_id"), F.col("doc_id").alias("_manual"), F.col("slug").alias("_slug")), ["collection", "doc_id"], "left")
    named = by_slug.select("request", "collection", F.coalesce("_manual", "doc_id").alias("doc_id"), "version", "_slug")
    whole = named.filter("version is not null")
    dated = editions.as_of(whole.drop("_slug"), docs.select("collection", "doc_id", "slug", "version", "version_later")).select("request", "slug", "how")
    bare = named.filter("version is null").join(docs.filter("is_current").select("collection", "doc_id", F.col("slug").alias("_now")), ["collection", "doc_id"], "left")
    now = bare.select("request", F.coalesce("_slug", "_now").alias("slug"), F.when(F.coalesce("_slug", "_now").isNotNull(), "current").otherwise("no edition").alias("how"))
    return dated.unionByName(now)


def search_docs(tables: Tables, requests: DataFrame) -> DataFrame:
    """requests (request, query, collection, document, version, limit, cap): ranked sections of the current editions, or of the one named, with where they are from and a snippet."""
    scope = _scoped(requests, tables)
    error = N.needs_document("version", "document")
    asked = requests.join(scope, "request", "left").withColumn("error", F.coalesce(error, F.when(F.col("how").isin("no edition", "not covered"), F.concat(F.lit("no edition of `"), "document", F.lit("` covers it")))))
    ok = asked.filter("error is null").withColumn("_limit", N.clamped("limit", 10, 1, 40)).withColumn("_cap", F.when(F.col("slug").isNotNull(), 0).otherwise(N.clamped("cap", 5, 0, 40)))
    key = ["collection", "slug", "ord"]
    chunks = tables["chunks"].join(tables["documents"].select("collection", "slug", "title", "version", "version_later", F.coalesce("is_current", F.lit(False)).alias("is_current")).withColumnRenamed("title", "manual"), ["collection", "slug"])
    terms = ok.select(F.col("request").alias("qid"), X.match_terms("query").alias("terms"))
    scored = search.ranked(terms, tables["postings"], tables["lengths"], key)
    wants = F.broadcast(ok.select(F.col("request").alias("qid"), "query", F.col("collection").alias("_in"), F.col("slug").alias("_one"), "_limit", "_cap"))
    met = scored.join(wants, "qid").join(chunks.select(*key, "is_current"), key).filter(((F.col("_in").isNull()) | (F.col("_in") == F.col("collection"))) & F.coalesce(F.col("_one") == F.col("slug"), F.col("is_current")))
    every = F.col("n_hit") == F.col("n_terms")
    met = met.withColumn("_all", F.count_if(every).over(Window.partitionBy("qid")) >= F.col("_limit")).filter(~F.col("_all") | every)
    pool = met.withColumn("_r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), *key))).filter(F.col("_r") <= F.greatest(F.col("_limit") * search.POOL_TIMES, F.lit(search.POOL_LEAST)))
    held = search.holding(pool, tables["chunks"], key).withColumn("_held", F.lit(True))
    rich = pool.drop("is_current").join(held, ["qid", *key], "left").join(chunks, key)
    best = search.adjusted(rich, held=F.coalesce("_held", F.lit(False)))
    by = lambda *p: Window.partitionBy(*p).orderBy(F.desc("adjusted"), *key)
    best = best.withColumn("_g", F.row_number().over(by("qid", "collection", "slug"))).filter((F.col("_cap") == 0) | (F.col("_g") <= F.col("_cap")))
    best = best.withColumn("rank", F.row_number().over(by("qid"))).filter(F.col("rank") <= F.col("_limit")).withColumn("terms", X.match_terms("query"))
    label = F.concat_ws(", ", "manual", N.edition_name("version", "version_later", "slug"))
    shown = search.snippets(best).select(F.col("qid").alias("request"), "rank", "chunk_id", "collection", "slug", "file", "heading", N.citation(label, "breadcrumb", "page_start", "page_end", "entity").alias("cite"), "snippet", F.col("adjusted").alias("score"), F.lit(None).cast("string").alias("error"))
    return shown.unionByName(asked.filter("error is not null").select("request", "error"), allowMissingColumns=True)


def get_section(tables: Tables, requests: DataFrame) -> DataFrame:
    """requests (request, section_id, file, query, context): see passages.sections."""
    chunks = tables["chunks"].join(tables["documents"].select("collection", "slug", "is_current"), ["collection", "slug"], "left")
    own = passages.sections(requests, chunks)
    return requests.select("request").join(own, "request", "left").withColumn("error", F.when(F.col("chunk_id").isNull(), "no such section"))


def lookup_entity(tables: Tables, requests: DataFrame) -> DataFrame:
    """requests (request, name): the text of each entry of that name, in current editions; else names like it."""
    now = tables["documents"].filter("is_current").select("collection", "slug")
    entities = tables["entities"].join(now, ["collection", "slug"], "left_semi")
    found = lookup.lookup(requests.select(F.col("request").alias("qid"), "name"), entities, ["collection", "slug"])
    texts = lookup.reassembled(tables["chunks"].filter("entity is not null"), ["collection", "slug", "entity"])
    hit = found.filter("entity is not null").join(texts.select("collection", "slug", "entity", "text", "cut"), ["collection", "slug", "entity"], "left")
    lost = found.filter("entity is null").select("qid", "name")
    near = lookup.suggestions(lost, entities.select("name_lower").distinct()).select("qid", "name", "suggested")
    return hit.unionByName(near.withColumn("error", F.lit("no such entry")), allowMissingColumns=True).withColumnRenamed("qid", "request")


def explain_log(tables: Tables, requests: DataFrame) -> DataFrame:
    """requests (request, log): the codes and rules of a log, the worst first, with the text of their entries."""
    lines = requests.select("request", F.posexplode(X.lines("log")).alias("pos", "line"))
    texts = lookup.reassembled(tables["chunks"].filter("entity is not null"), ["collection", "slug", "entity"]).select(F.lower("entity").alias("name_lower"), "text")
    return lookup.explained(lookup.scan_log(lines, ["request"]), texts, ["request"])


def check_script(tables: Tables, requests: DataFrame) -> DataFrame:
    """requests (request, script): commands that no reference has, and options that a command's entries don't show."""
    calls = script_lint.calls(requests.select(F.col("request").cast("string").alias("script_id"), F.col("script").alias("text")))
    texts = lookup.reassembled(tables["chunks"].filter("entity is not null"), ["collection", "slug", "entity"]).select(F.lower("entity").alias("name_lower"), "text")
    return script_lint.first_rows(script_lint.checked(calls, texts)).withColumnRenamed("script_id", "request")


def list_documents(tables: Tables, requests: DataFrame) -> DataFrame:
    """requests (request, collection): the documents of a collection, or all, with the number of editions of their manual."""
    docs = catalog_tables.listing(tables["documents"])
    return requests.select("request", F.col("collection").alias("_in")).join(docs, F.col("_in").isNull() | (F.col("_in") == F.col("collection"))).drop("_in")


def get_toc(tables: Tables, requests: DataFrame) -> DataFrame:
    """requests (request, collection, document, version, max_level, contains): an edition's outline down to a level, or every entry whose title has a text."""
    scope = _scoped(requests, tables).select("request", "slug")
    docs = tables["documents"].select("collection", "slug", F.posexplode("toc").alias("idx", "e")).select("collection", "slug", "idx", "e.*")
    return toc_filter(requests.join(scope, "request").join(docs, ["collection", "slug"]))


def toc_filter(rows: DataFrame) -> DataFrame:
    """Rows (max_level, contains, level, title, page) that are shown."""
    has = F.coalesce(F.trim("contains"), F.lit("")) != ""
    return rows.filter(F.when(has, F.lower("title").contains(F.lower(F.trim("contains")))).otherwise(F.col("level") <= N.clamped("max_level", TOC_LEVELS, 1, 99)))


def compare_versions(tables: Tables, requests: DataFrame) -> DataFrame:
    """requests (request, collection, old, new: slugs, name): the lines of an entry that only one edition has, or that differ in blanks and quotes alone."""
    chunks = tables["chunks"].filter("entity is not null").withColumn("body", X.without_crumb("body", "breadcrumb"))

    def side(column: str) -> DataFrame:
        asked = requests.select("request", "collection", F.col(column).alias("slug"), F.lower("name").alias("_n"))
        own = asked.join(chunks.withColumn("_n", F.lower("entity")), ["collection", "slug", "_n"])
        return own.groupBy("request").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "body"))), lambda x: x.body), "\n").alias("text"))

    return compare.entry_diff(side("old"), side("new"), ["request"])


TOOLS: dict[str, Callable[[Tables, DataFrame], DataFrame]] = {f.__name__: f for f in (search_docs, get_section, lookup_entity, explain_log, check_script, list_documents, get_toc, compare_versions)}
