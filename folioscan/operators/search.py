"""Ranked retrieval for tables of queries: postings, BM25, all-terms-else-any, re-ranking, caps.

A batch of queries is one plan. Documents are tokenised in their rows, and only terms that some query has leave
them; counts are partial before they are shuffled. The query vocabulary is joined without a hint, so that Spark
broadcasts it only where its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X

K1, B = 1.2, 0.75
#: Weights of heading, entity, breadcrumb, body and figure text (fixed values).
WEIGHTS = {"heading": 10.0, "entity": 8.0, "breadcrumb": 3.0, "body": 1.0, "figures": 1.0}
#: A query vocabulary of up to so many terms is broadcast; a larger one is joined by shuffling.
BROADCAST_TERMS = 200_000
#: Pairs of a query and a document that one task scores, at most about.
PAIRS = 1_000_000
#: How many candidates are re-ranked: so many times the limit, and no fewer.
POOL_TIMES, POOL_LEAST = 20, 200


def lengths(docs: DataFrame, key: list[str], fields: dict[str, float], tokens=X.words) -> DataFrame:
    """docs with all (term, weight) occurrences in one array, and their number."""
    def weighed(field: str, weight: float) -> Column:
        return F.transform(tokens(F.coalesce(F.col(field), F.lit(""))), lambda t: F.struct(t.alias("term"), F.lit(float(weight)).alias("w")))

    parts = [weighed(f, w) for f, w in fields.items()]
    return docs.select(*key, F.concat(*parts).alias("occurrences")).withColumn("n_tokens", F.size("occurrences"))


def postings(docs: DataFrame, key: list[str], fields: dict[str, float], vocabulary: DataFrame | None = None, tokens=X.words) -> DataFrame:
    """(key, n_tokens, term, f): weighted occurrences of each term, of those in the vocabulary if one is given."""
    flat = lengths(docs, key, fields, tokens).select(*key, "n_tokens", F.inline("occurrences"))
    if vocabulary is not None:
        terms = vocabulary.select("term").distinct()
        few = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
        flat = flat.join(F.broadcast(terms) if few else terms, "term", "left_semi")
    return flat.groupBy(*key, "n_tokens", "term").agg(F.sum("w").alias("f"))


def term_stats(docs: DataFrame, key: list[str], field: str) -> DataFrame:
    """(term, df, cf) of a whole collection."""
    return postings(docs, key, {field: 1.0}).groupBy("term").agg(F.count("*").alias("df"), F.sum("f").cast("long").alias("cf"))


def idf(n: Column, df: Column) -> Column:
    raw = F.log((n - df + 0.5) / (df + 0.5))
    return F.when(raw > 0, raw).otherwise(1e-6)


def is_few(rows: DataFrame, most: int = BROADCAST_TERMS) -> bool:
    """Whether there are at most so many rows: counted, not estimated."""
    return rows.limit(most + 1).count() <= most


def by_document(found: DataFrame, queries: DataFrame, lengths_: DataFrame, key: list[str]) -> DataFrame:
    """Postings dealt out by document, so that all that scores a document is in one task and no pair of it and a query is shuffled."""
    pairs = queries.count() * lengths_.count()
    return found.repartition(max(found.sparkSession.sparkContext.defaultParallelism, -(-pairs // PAIRS)), *key)


def ranked(queries: DataFrame, found: DataFrame, lengths_: DataFrame, key: list[str], dealt: bool = False) -> DataFrame:
    """(qid, key, score, n_hit, n_terms) of queries (qid, terms) over postings (term, key, n_tokens, f) and lengths (key, n_tokens); higher is better.

    Averages and document frequencies are of the whole table, whatever is filtered afterwards. Queries are few beside postings: below a counted
    number of terms they are broadcast, only their terms' postings are read, and these move once, by document (unless they are `dealt` so already).
    """
    wanted = queries.select("qid", F.size("terms").alias("n_terms"), F.explode("terms").alias("term"))
    few = is_few(wanted)
    small = F.broadcast if few else lambda df: df
    own = found.join(small(wanted.select("term").distinct()), "term", "left_semi")
    frequency = own.groupBy("term").agg(F.count("*").alias("df"))
    whole = lengths_.agg(F.count("*").alias("n"), F.avg("n_tokens").alias("mean")).select(F.struct("n", "mean"))
    weighed = wanted.join(frequency, "term").withColumn("whole", whole.scalar()).select("qid", "n_terms", "term", idf(F.col("whole.n"), F.col("df")).alias("idf"), F.col("whole.mean").alias("mean"))
    f, share = F.col("f"), F.col("n_tokens") / F.col("mean")
    gain = F.col("idf") * f * (K1 + 1) / (f + K1 * (1 - B + B * share))
    rows = by_document(own, queries, lengths_, key) if few and not dealt else own
    return rows.join(small(weighed), "term").groupBy("qid", *key).agg(F.round(F.sum(gain), 6).alias("score"), F.count("*").alias("n_hit"), F.first("n_terms").alias("n_terms"))


def bm25(queries: DataFrame, docs: DataFrame, key: list[str], fields: dict[str, float], tokens=X.words) -> DataFrame:
    """As ranked(), without an index: documents are tokenised, and only the terms of queries leave their rows."""
    wanted = queries.select(F.explode("terms").alias("term"))
    return ranked(queries, postings(docs, key, fields, wanted, tokens), lengths(docs, key, fields, tokens), key)


def all_else_any(scored: DataFrame, limit: int) -> DataFrame:
    """Documents with all terms where a query has `limit` of them; else those with any, in place of the former."""
    every = F.col("n_hit") == F.col("n_terms")
    # Counts of each query come to its rows, not all its rows to one task; there is at most one row a query.
    enough = scored.filter(every).groupBy("qid").agg(F.count("*").alias("_n")).filter(F.col("_n") >= limit).select("qid", F.lit("all").alias("_mode"))
    met = scored.join(F.broadcast(enough), "qid", "left")
    return met.withColumn("mode", F.coalesce("_mode", F.lit("any"))).filter((F.col("mode") == "any") | every).select(*scored.columns, "mode")


def pool(scored: DataFrame, key: list[str], limit: int) -> DataFrame:
    """The best candidates of each query, as many as are re-ranked."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), *key)
    return scored.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= max(POOL_TIMES * limit, POOL_LEAST)).drop("_r")


def adjusted(rows: DataFrame, query: str = "query", heading: str = "heading", entity: str = "entity", body: str = "body", held: Column | None = None) -> DataFrame:
    """score + what the heading, the entity, the size and the kind of a section say; rows keep all columns.

    The entity is named if the query is the entity, in one word or several, if an identifier of the query is, or if its two to four words stand in the query in a row.

    Fixed values: 6 for the entity named, 4 for the heading itself, 1.5 for a heading with all query words, 3 for a
    section that holds a named identifier, -1.5 under 200 characters, -8 for front matter.
    """
    q = X.ascii_words(query)
    spaced, joined = F.array_join(q, " "), F.array_join(q, "_")
    tokens = F.concat(F.lit(" "), F.array_join(X.query_tokens(query), " "), F.lit(" "))
    name = F.lower(X.collapse(F.coalesce(F.col(entity), F.lit(""))))
    said = F.size(F.split(name, " ")).between(2, 4) & tokens.contains(F.concat(F.lit(" "), name, F.lit(" ")))
    named = (name != "") & ((name == joined) | (F.translate(name, "_", " ") == spaced) | F.array_contains(X.named_identifiers(query), name) | said)
    title = F.lower(F.coalesce(F.col(heading), F.lit("")))
    itself = (title != "") & ((title == spaced) | (F.translate(title, "_", " ") == spaced))
    content = F.filter(q, lambda w: ~w.isin(X.STOPWORDS))
    inside = (title != "") & (F.size(content) > 0) & (F.size(F.array_except(content, X.ascii_words(title))) == 0)
    delta = (
        F.when(named, 6.0).otherwise(0.0)
        + F.when(itself, 4.0).when(inside, 1.5).otherwise(0.0)
        + F.when(held if held is not None else F.lit(False), 3.0).otherwise(0.0)
        - F.when(F.length(body) < 200, 1.5).otherwise(0.0)
        - F.when(X.is_noise(heading, body), 8.0).otherwise(0.0)
    )
    # A query without a word stays as it is.
    return rows.withColumn("adjusted", F.round(F.col("score") + F.when(F.size(q) > 0, delta).otherwise(0.0), 6))


def capped(rows: DataFrame, key: list[str], group: list[str], cap: int, limit: int, score: str = "score") -> DataFrame:
    """rank: the best `limit` of each query, at most `cap` of one group (0: no cap)."""
    order = [F.desc(score), *key]
    if cap:
        rows = rows.withColumn("_g", F.row_number().over(Window.partitionBy("qid", *group).orderBy(*order))).filter(F.col("_g") <= cap).drop("_g")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(*order))).filter(F.col("rank") <= limit)


def holding(candidates: DataFrame, docs: DataFrame, key: list[str], body: str = "body", query: str = "query") -> DataFrame:
    """(qid, key) of candidates whose text holds an identifier that the query names. Only candidates are looked into."""
    asked = candidates.select("qid", *key, F.explode(X.named_identifiers(query)).alias("ident"))
    held = docs.join(asked.select(*key).distinct(), key, "left_semi").select(*key, F.explode(F.array_distinct(X.identifiers(body))).alias("ident"))
    return asked.join(held, [*key, "ident"], "left_semi").select("qid", *key).distinct()


def passage_scores(rows: DataFrame, passage: str = "passages", terms: str = "terms", idents: Column | None = None) -> DataFrame:
    """(…, passage_no, passage_score) of each passage: sum over terms of weight * ln(1 + P / df); terms in all passages don't count.

    rows have an array of passages and one of light-stemmed terms each; everything is done within the row's own passages.
    """
    keep = [c for c in rows.columns if c not in (passage, terms)]
    number = rows.select(*keep, F.col(terms).alias("_t"), F.size(passage).alias("_p"), F.posexplode(passage).alias("passage_no", "_text"))
    hits = number.select(*keep, "_p", "passage_no", F.explode(F.array_intersect(F.array_distinct(F.transform(X.ascii_words("_text"), X.light_stem)), "_t")).alias("term"))
    seen = hits.withColumn("_df", F.count("*").over(Window.partitionBy(*keep, "term"))).filter(F.col("_df") < F.col("_p"))
    return seen.groupBy(*keep, "passage_no").agg(F.round(F.sum(F.log(1 + F.col("_p") / F.col("_df")) * (idents if idents is not None else F.lit(1.0))), 6).alias("passage_score"))


def search(queries: DataFrame, chunks: DataFrame, limit: int = 10, cap: int = 5, index: dict[str, DataFrame] | None = None) -> DataFrame:
    """queries (qid, query) over chunks (collection, slug, ord, heading, entity, breadcrumb, body, figures, is_current): ranked sections. With the tables of an index, its postings are read."""
    key, group = ["collection", "slug", "ord"], ["collection", "slug"]
    asked = queries.withColumn("terms", X.match_terms("query"))
    every = bm25(asked, chunks, key, WEIGHTS) if index is None else ranked(asked, index["postings"], index["lengths"], key)
    scored = every.join(chunks.filter("is_current").select(*key), key, "left_semi")
    best = pool(all_else_any(scored, limit), key, limit).join(queries, "qid")
    held = holding(best, chunks, key).withColumn("_held", F.lit(True))
    rich = best.join(held, ["qid", *key], "left").join(chunks.select(*key, "heading", "entity", "body"), key)
    ranked = capped(adjusted(rich, held=F.coalesce("_held", F.lit(False))), key, group, cap, limit, "adjusted")
    return ranked.select("qid", "rank", *key, "heading", "entity", "score", "adjusted", "mode")


def phrases(query: Column | str) -> Column:
    """Terms of a query as runs of words, (words, whether the last is a prefix): what is quoted first, then single words; stop words go if others are left.

    A word with separators inside (set_clock) is the run of its parts. A star behind a word or inside quotes at the end asks for a prefix.
    """
    q = F.col(query) if isinstance(query, str) else query
    quoted = F.regexp_extract_all(q, F.lit('"([^"]*)"'), F.lit(1))
    loose = F.filter(F.split(F.regexp_replace(q, '"[^"]*"', " "), X.SPACES), lambda w: F.size(X.ascii_words(w)) > 0)
    content = F.filter(loose, lambda w: ~F.forall(X.ascii_words(w), lambda p: p.isin(X.STOPWORDS)))
    quoted = F.filter(quoted, lambda w: F.size(X.ascii_words(w)) > 0)
    singles = F.when((F.size(content) > 0) | (F.size(quoted) > 0), content).otherwise(loose)
    return F.transform(F.concat(quoted, singles), lambda w: F.struct(X.ascii_words(w).alias("words"), w.endswith("*").alias("prefix")))


def phrase_matches(queries: DataFrame, docs: DataFrame, key: list[str], field: str) -> DataFrame:
    """(qid, key, n_hit, n_terms): how many terms of each query (qid, query) a field holds; the words of a term stand in a row, the last may be a prefix.

    Terms and documents meet by equal keys: a word, two words in a row, or either with its last word cut to a prefix's length. Terms of more words begin with two,
    and only those are looked for in the texts where they do. Keys become distinct as strings (a hash), before they have their kind (structures are compared each with each).
    """
    terms = queries.select("qid", F.posexplode(phrases("query")).alias("no", "t")).select("qid", "no", "t.*")
    n = terms.groupBy("qid").agg(F.count("*").alias("n_terms"))
    size = F.size("words")
    two = F.least(size, F.lit(2))
    cut = F.when(F.col("prefix") & (size <= 2), F.length(F.element_at("words", -1))).otherwise(0)
    run = F.concat(F.lit(" "), F.array_join("words", " "), F.when(F.col("prefix"), "").otherwise(" "))
    terms = terms.select("qid", "no", two.alias("n"), cut.alias("cut"), F.array_join(F.slice("words", F.lit(1), two), " ").alias("key"), F.when(size > 2, run).alias("_run"))
    kinds = sorted((r.n, r.cut) for r in terms.select("n", "cut").distinct().collect())  # as many as there are lengths of prefixes, twice at most

    def keys(number: int, cut: int) -> Column:
        last = lambda x: F.when(F.length(x) >= cut, F.left(x, F.lit(cut))) if cut else x
        most = F.greatest(F.size("w") - 1, F.lit(0))
        found = F.transform("w", lambda x: last(x)) if number == 1 else F.zip_with(F.slice("w", F.lit(1), most), F.slice("w", F.lit(2), most), lambda a, b: F.concat(a, F.lit(" "), last(b)))
        return F.transform(F.array_distinct(found), lambda k: F.struct(F.lit(number).alias("n"), F.lit(cut).alias("cut"), k.alias("key")))

    own = docs.select(*key, X.ascii_words(F.coalesce(F.col(field), F.lit(""))).alias("w"))
    few = terms.limit(BROADCAST_TERMS + 1).count() <= BROADCAST_TERMS
    made = F.flatten(F.array(*[keys(*k) for k in kinds])) if kinds else F.array().cast("array<struct<n:int,cut:int,key:string>>")
    heads = own.select(*key, F.inline(made)).join(F.broadcast(terms) if few else terms, ["n", "cut", "key"])
    # Words joined by single blanks: a run of them is a part of that text.
    text = own.select(*key, F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" ")).alias("_t"))
    long = heads.filter("_run is not null").join(text, key).filter(F.col("_t").contains(F.col("_run")))
    found = heads.filter("_run is null").select("qid", *key, "no")
    if not terms.filter("_run is not null").isEmpty():
        found = found.union(long.select("qid", *key, "no"))
    found = found.distinct()
    return found.groupBy("qid", *key).agg(F.count("*").alias("n_hit")).join(n, "qid")


def snippets(rows: DataFrame, body: str = "body", terms: str = "terms", size: int = 28, marks: tuple[str, str, str] = ("[", "]", "…")) -> DataFrame:
    """rows with snippet: the first window of `size` words that has the most different terms, these marked, with dots where text is left out."""
    tokens, own = F.split(F.trim(X.collapse(body)), " "), F.col(terms)
    row = rows.withColumn("_w", tokens).withColumn("_h", F.transform("_w", lambda w: F.array_intersect(X.words(w), own)))
    # A window whose last word is no hit has no more terms than the one before it, so the first of the best begins the text or ends in a hit.
    starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size("_w") - size, F.lit(0))), lambda i: (i == 0) | (F.size(F.get("_h", i + (size - 1))) > 0))
    best = F.array_max(F.transform(starts, lambda i: F.struct(F.size(F.array_distinct(F.flatten(F.slice("_h", i + 1, F.lit(size))))).alias("n"), (-i).alias("at"))))
    row = row.withColumn("_at", -best["at"])
    shown = F.array_join(F.transform(F.slice(F.arrays_zip("_w", "_h"), F.col("_at") + 1, F.lit(size)), lambda x: F.when(F.size(x["_h"]) > 0, F.concat(F.lit(marks[0]), x["_w"], F.lit(marks[1]))).otherwise(x["_w"])), " ")
    text = F.concat(F.when(F.col("_at") > 0, marks[2]).otherwise(""), shown, F.when(F.col("_at") + size < F.size("_w"), marks[2]).otherwise(""))
    return row.withColumn("snippet", text).drop("_w", "_h", "_at")
