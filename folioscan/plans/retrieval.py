"""Queries: retrieval, evaluation, quotes and shingles, over documents and benchmark items."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioscan.functions import text as X
from folioscan.functions.udfs import stem_term
from folioscan.operators import compare as C
from folioscan.operators import evaluate as E
from folioscan.operators import index as I
from folioscan.operators import lookup as L
from folioscan.operators import search as S
from folioscan.sources import store

from .registry import query, table

#: Items whose pools of documents are broadcast.
POOLS = 2_000
_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_SCORED = rf"""
t AS (SELECT doc_id, source, {_TOKENS} AS w FROM documents),
n AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM t),
q AS (SELECT DISTINCT qid, unnest(terms) AS term FROM asked),
nt AS (SELECT qid, count(*) AS n_terms FROM q GROUP BY qid),
p AS (SELECT doc_id, source, len(w) AS l, unnest(w) AS term FROM t),
f AS (SELECT doc_id, source, l, term, count(*) AS f FROM p WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM f GROUP BY term),
i AS (SELECT term, CASE WHEN ln((n.n - df + 0.5) / (df + 0.5)) > 0 THEN ln((n.n - df + 0.5) / (df + 0.5)) ELSE 1e-6 END AS idf FROM df, n),
scored AS (SELECT q.qid, f.doc_id, f.source, round(sum(idf * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * l / n.mean))), 6) AS score, count(*) AS n_hit FROM q JOIN f USING (term) JOIN i USING (term), n GROUP BY ALL)
"""
_CAPPED = """
capped AS (SELECT *, row_number() OVER (PARTITION BY qid, source ORDER BY score DESC, doc_id) AS g FROM {0}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM capped WHERE g <= 5)
"""
_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)
_ITEMS = rf"asked AS (SELECT item_id AS qid, list_distinct({_TOKENS}) AS terms FROM benchmark)"


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text")


def _items(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.array_distinct(X.words("text")).alias("terms"))


def _index(spark, sf_dir):
    """Postings, lengths and terms of the documents: built by the first query that needs them, read by all."""
    docs = _docs(spark, sf_dir)

    def make():
        return I.postings(docs, ["doc_id", "source"], {"text": 1.0})

    found = store.built(spark, "postings", [docs], make)
    return found | store.built(spark, "terms", [docs], lambda: {"terms": I.terms(found["postings"])})


def _scored(spark, sf_dir, queries):
    own = _index(spark, sf_dir)
    return S.ranked(queries, own["postings"], own["lengths"], ["doc_id", "source"])


@query(rf"""WITH t AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM documents) SELECT term, count(DISTINCT doc_id) AS df, count(*) AS cf FROM t GROUP BY term""")
def term_stats(spark, sf_dir):
    """Document and collection frequency of every term."""
    return _index(spark, sf_dir)["terms"].select("term", "df", F.col("cf").cast("long").alias("cf"))


@query(f"WITH {_ITEMS}, {_SCORED}, {_CAPPED.format('scored')} SELECT qid, rank, doc_id, score FROM ranked WHERE rank <= 10")
def bm25_topk(spark, sf_dir):
    """Benchmark items as queries: the ten best documents of each, five of one source."""
    return S.capped(_scored(spark, sf_dir, _items(spark, sf_dir)), ["doc_id"], ["source"], 5, 10).select("qid", "rank", "doc_id", "score")


_RARE = "asked AS (SELECT qid, list(term ORDER BY df, term)[1:4] AS terms FROM (SELECT item_id AS qid, unnest(list_distinct(" + _TOKENS + ")) AS term FROM benchmark) JOIN (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(" + _TOKENS + ") AS term FROM documents) GROUP BY term) USING (term) GROUP BY qid)"


@query(f"""WITH {_RARE}, {_SCORED},
m AS (SELECT *, count(*) FILTER (WHERE n_hit = n_terms) OVER (PARTITION BY qid) >= 3 AS enough FROM scored JOIN nt USING (qid)),
c AS (SELECT *, CASE WHEN enough THEN 'all' ELSE 'any' END AS mode FROM m WHERE NOT enough OR n_hit = n_terms),
{_CAPPED.format('c')} SELECT qid, rank, doc_id, score, mode FROM ranked WHERE rank <= 10""")
def bm25_and_or(spark, sf_dir):
    """The four rarest words of each whole item: documents with all of them, or with any where those are fewer than three."""
    df = _index(spark, sf_dir)["terms"].select("term", "df")
    flat = _items(spark, sf_dir).select("qid", F.explode("terms").alias("term")).join(df, "term")
    asked = flat.groupBy("qid").agg(F.slice(F.transform(F.sort_array(F.collect_list(F.struct("df", "term"))), lambda x: x.term), 1, 4).alias("terms"))
    return S.capped(S.all_else_any(_scored(spark, sf_dir, asked), 3), ["doc_id"], ["source"], 5, 10).select("qid", "rank", "doc_id", "score", "mode")


@query(rf"""WITH {_ITEMS}, {_SCORED}, its AS (SELECT item_id AS qid, row_number() OVER (ORDER BY item_id) - 1 AS k, count(*) OVER () AS n_items, text AS asked_text, regexp_extract_all(lower(text), '[0-9a-z]+') AS c,
  ' ' || array_to_string(list_filter(list_transform(regexp_split_to_array(text, '[ \t\n\v\f\r]+'), lambda x: lower(regexp_replace(regexp_replace(regexp_replace(x, '^[`''"()\[\]{{}}<>,;:?!]+', ''), '[`''"()\[\]{{}}<>,;:?!]+$', ''), '\.+$', ''))), lambda x: x <> ''), ' ') || ' ' AS tokens FROM benchmark),
ents AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN c[3] || ' ' || c[4] ELSE array_to_string(c, '_') END AS entity FROM documents d JOIN its ON k = d.doc_id % n_items),
pool AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS r FROM scored),
b AS (SELECT pool.*, its.c, its.tokens, ents.entity, d.text, lower(split_part(d.text, chr(10), 1)) AS title, regexp_extract_all(lower(split_part(d.text, chr(10), 1)), '[0-9a-z]+') AS h, list_filter(its.c, lambda x: x NOT IN ({_STOP})) AS content,
  len(list_filter(string_split(d.text, chr(10)), lambda x: trim(x, ' ') <> '')) AS n_lines, len(list_filter(string_split(d.text, chr(10)), lambda x: regexp_matches(x, '\.\s?\.\s?\.\s?\.'))) AS led FROM pool JOIN documents d USING (doc_id) JOIN its USING (qid) LEFT JOIN ents USING (doc_id) WHERE r <= 200),
a AS (SELECT qid, doc_id, source, round(score + CASE WHEN entity = array_to_string(c, '_') OR replace(entity, '_', ' ') = array_to_string(c, ' ') OR (entity LIKE '% %' AND contains(tokens, ' ' || entity || ' ')) THEN 6.0 ELSE 0.0 END
  + CASE WHEN title IN (array_to_string(c, ' '), array_to_string(c, '_')) THEN 4.0 WHEN title <> '' AND len(content) > 0 AND list_has_all(h, content) THEN 1.5 ELSE 0.0 END
  - CASE WHEN length(text) < 200 THEN 1.5 ELSE 0.0 END - CASE WHEN n_lines >= 4 AND 10 * led >= 3 * n_lines THEN 8.0 ELSE 0.0 END, 6) AS score FROM b),
{_CAPPED.format('a')} SELECT qid, rank, doc_id, score AS adjusted FROM ranked WHERE rank <= 10""")
def rerank_cap_topk(spark, sf_dir):
    """The pool of each item, with what entities, headings, sizes and front matter say added, capped and cut. Documents own an entity of two words, or of one, of some item."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    # The benchmark is small: its rows are numbered in one task.
    its = items.select("item_id", X.ascii_words("text").alias("c")).withColumn("k", F.row_number().over(Window.orderBy("item_id")) - 1)
    n = items.agg(F.count("*")).scalar()
    entity = F.when(F.col("doc_id") % 2 == 0, F.concat_ws(" ", F.get("c", F.lit(2)), F.get("c", F.lit(3)))).otherwise(F.array_join("c", "_"))
    owned = docs.select("doc_id", (F.col("doc_id") % n).alias("k"), F.substring_index("text", "\n", 1).alias("heading"), F.col("text").alias("body")).join(its.select("k", "c"), "k", "left").select("doc_id", "heading", entity.alias("entity"), "body")
    best = S.pool(_scored(spark, sf_dir, _items(spark, sf_dir)), ["doc_id"], 10).join(items.select(F.col("item_id").alias("qid"), F.col("text").alias("query")), "qid")
    # The pools are a few hundred rows an item: they go to the texts, where these are read.
    few = S.is_few(items.select("item_id"), POOLS)
    return S.capped(S.adjusted((F.broadcast(best) if few else best).join(owned, "doc_id")), ["doc_id"], ["source"], 5, 10, "adjusted").select("qid", "rank", "doc_id", "adjusted")


_STEM = "CASE WHEN {0} LIKE '%ing' AND length({0}) >= 6 THEN {0}[:-4] WHEN {0} LIKE '%ed' AND length({0}) >= 5 THEN {0}[:-3] WHEN {0} LIKE '%es' AND length({0}) >= 5 THEN {0}[:-3] WHEN {0} LIKE '%s' AND length({0}) >= 4 THEN {0}[:-2] ELSE {0} END"


@query(f"""WITH {_ITEMS}, {_SCORED}, {_CAPPED.format('scored')},
top AS (SELECT qid, doc_id FROM ranked WHERE rank <= 3),
st AS (SELECT DISTINCT item_id AS qid, {_STEM.format('x')} AS stem FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[0-9a-z]+')) AS x FROM benchmark)),
ps AS (SELECT qid, doc_id, len(l) AS p, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS passage_no FROM (SELECT qid, doc_id, string_split(text, chr(10)) AS l FROM top JOIN documents USING (doc_id))),
hs AS (SELECT DISTINCT qid, doc_id, p, passage_no, {_STEM.format('x')} AS stem FROM (SELECT qid, doc_id, p, passage_no, unnest(regexp_extract_all(lower(line), '[0-9a-z]+')) AS x FROM ps)),
hit AS (SELECT hs.*, count(*) OVER (PARTITION BY hs.qid, doc_id, hs.stem) AS df FROM hs JOIN st ON st.qid = hs.qid AND st.stem = hs.stem)
SELECT qid, doc_id, passage_no, round(sum(ln(1 + p / df)), 6) AS passage_score FROM hit WHERE df < p GROUP BY ALL""")
def passage_scores(spark, sf_dir):
    """Lines of the three best documents of each item, scored by how few of the document's lines have the item's words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", X.lines("text").alias("passages"))
    top = bm25_topk(spark, sf_dir).filter("rank <= 3").select("qid", "doc_id")
    stems = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.array_distinct(F.transform(X.ascii_words("text"), X.light_stem)).alias("terms"))
    few = S.is_few(stems.select("qid"), POOLS)
    return S.passage_scores((F.broadcast(top) if few else top).join(docs, "doc_id").join(stems, "qid"))


@query(f"WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[0-9a-z]+')) AS w FROM documents) SELECT {_STEM.format('w')} AS stem, count(*) AS n_words FROM w GROUP BY ALL")
def light_stem_vocab(spark, sf_dir):
    """How many words of the vocabulary share each light stem."""
    vocabulary = table(spark, sf_dir, "documents").select(F.explode(X.ascii_words("text")).alias("w")).distinct()
    return vocabulary.groupBy(X.light_stem("w").alias("stem")).agg(F.count("*").alias("n_words"))


@query()
def stemmed_search(spark, sf_dir):
    """bm25_topk over folded Porter stems: only distinct words are stemmed."""
    own = _index(spark, sf_dir)
    stems = own["terms"].select("term", "stem")
    asked = _items(spark, sf_dir).select("qid", F.explode("terms").alias("w"))
    terms = asked.join(asked.select("w").distinct().select("w", stem_term("w").alias("s")), "w").groupBy("qid").agg(F.collect_set("s").alias("terms"))
    wanted = stems.join(terms.select(F.explode("terms").alias("stem")).distinct(), "stem", "left_semi")
    key, few = ["doc_id", "source"], S.is_few(wanted)
    met = own["postings"].join(F.broadcast(wanted) if few else wanted, "term")
    found = S.by_document(met, terms, own["lengths"], key).groupBy(*key, "n_tokens", F.col("stem").alias("term")).agg(F.sum("f").alias("f"))
    return S.capped(S.ranked(terms, found, own["lengths"], key, dealt=True), ["doc_id"], ["source"], 5, 10).select("qid", "rank", "doc_id", "score")


_QUOTES = """pairs AS (SELECT item_id, doc_id FROM (SELECT item_id, trim(regexp_replace(text, '[ \\t\\n\\v\\f\\r]+', ' ', 'g'), ' ') AS quote FROM benchmark), (SELECT doc_id, trim(regexp_replace(text, '[ \\t\\n\\v\\f\\r]+', ' ', 'g'), ' ') AS body FROM documents) WHERE quote <> '' AND contains(body, quote))"""


@query(f"""WITH {_QUOTES}, n AS (SELECT item_id, count(*) AS n, array_to_string(list_sort(list(doc_id)), ',') AS ids FROM pairs GROUP BY item_id)
SELECT item_id, coalesce(n, 0) AS n_sections, CASE WHEN n BETWEEN 1 AND 3 THEN 'resolved' ELSE 'stale' END AS state, CASE WHEN n BETWEEN 1 AND 3 THEN ids END AS sections FROM benchmark LEFT JOIN n USING (item_id)""")
def quote_resolution(spark, sf_dir):
    """Each item as a quote: resolved if one to three documents hold it."""
    asked, docs = table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents")
    return C.resolved_quotes(asked, C.quotes(asked, docs, "item_id", "doc_id"), "item_id", "doc_id")


_SHINGLES = r"CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"


@query(rf"""WITH a0 AS (SELECT item_id, {_SHINGLES} AS s FROM (SELECT item_id, {_TOKENS} AS w FROM benchmark)), a AS (SELECT item_id, len(s) AS n, unnest(s) AS x FROM a0),
b AS (SELECT doc_id, unnest({_SHINGLES}) AS x FROM (SELECT doc_id, {_TOKENS} AS w FROM documents)),
m AS (SELECT item_id, n, doc_id, x FROM a JOIN b USING (x)),
sc AS (SELECT item_id, doc_id, round(count(*) / n, 6) AS score FROM m GROUP BY item_id, n, doc_id),
r AS (SELECT *, row_number() OVER o AS k, coalesce(lead(score) OVER o, 0) AS nxt FROM sc WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id)),
pt AS (SELECT item_id, doc_id FROM sc WHERE score >= 0.3),
u AS (SELECT item_id, n, count(DISTINCT x) AS mm, array_to_string(list_sort(list(DISTINCT doc_id)), ',') AS ids, count(DISTINCT doc_id) AS k FROM m JOIN pt USING (item_id, doc_id) GROUP BY item_id, n)
SELECT b.item_id, CASE WHEN r.score >= 0.6 AND r.score - r.nxt >= 0.2 THEN 'one' WHEN u.k > 1 AND u.mm >= 0.8 * u.n THEN 'several' ELSE 'none' END AS how,
CASE WHEN r.score >= 0.6 AND r.score - r.nxt >= 0.2 THEN r.doc_id::VARCHAR WHEN u.k > 1 AND u.mm >= 0.8 * u.n THEN u.ids END AS new_ids
FROM benchmark b LEFT JOIN (SELECT * FROM r WHERE k = 1) r USING (item_id) LEFT JOIN u USING (item_id)""")
def shingle_remap(spark, sf_dir):
    """Where each item's text went: to one document, to several together, or nowhere."""
    return C.remapped(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), "item_id", "doc_id")


@query("SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def missing_answers(spark, sf_dir):
    """Documents that no label refers to."""
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


_KIND = "CASE item_id % 3 WHEN 0 THEN 'identifier' WHEN 1 THEN 'concept' ELSE 'paraphrase' END"


def _questions(spark, sf_dir):
    kind = F.when(F.col("item_id") % 3 == 0, "identifier").when(F.col("item_id") % 3 == 1, "concept").otherwise("paraphrase")
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), kind.alias("kind"))


@query(f"""WITH {_ITEMS}, {_SCORED}, {_CAPPED.format('scored')}, {_QUOTES},
g AS (SELECT qid, min(rank) AS rank FROM ranked JOIN pairs ON item_id = qid AND ranked.doc_id = pairs.doc_id WHERE rank <= 10 GROUP BY qid),
k AS (SELECT {_KIND} AS kind, rank FROM benchmark LEFT JOIN g ON qid = item_id)
SELECT coalesce(kind, 'all') AS kind, count(*) AS n, {', '.join(f'round(avg(CASE WHEN rank <= {i} THEN 1.0 ELSE 0.0 END), 6) AS hit_{i}' for i in (1, 3, 5, 10))}, round(avg(CASE WHEN rank <= 10 THEN 1 / rank ELSE 0.0 END), 6) AS mrr FROM k GROUP BY ROLLUP (kind)""")
def hit_at_k_rollup(spark, sf_dir):
    """Hit rates of bm25_topk by kind of question, gold being the documents that hold the quote."""
    asked, docs = table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents")
    gold = C.quotes(asked, docs, "item_id", "doc_id").withColumnRenamed("item_id", "qid")
    return E.hit_rates(E.first_rank(_questions(spark, sf_dir), bm25_topk(spark, sf_dir), gold, ["doc_id"]))


@query(f"""WITH {_ITEMS}, {_SCORED}, {_CAPPED.format('scored')}, {_QUOTES},
open AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score / (1 + n_hit) DESC, doc_id) AS rank FROM scored),
a AS (SELECT item_id AS qid, rank FROM benchmark LEFT JOIN (SELECT qid, min(rank) AS rank FROM ranked JOIN pairs ON item_id = qid AND ranked.doc_id = pairs.doc_id WHERE rank <= 10 GROUP BY qid) ON qid = item_id),
b AS (SELECT item_id AS qid, rank FROM benchmark LEFT JOIN (SELECT qid, min(rank) AS rank FROM open JOIN pairs ON item_id = qid AND open.doc_id = pairs.doc_id WHERE rank <= 10 GROUP BY qid) ON qid = item_id)
SELECT qid, a.rank AS rank_a, b.rank AS rank_b, CASE WHEN coalesce(b.rank, 1073741824) < coalesce(a.rank, 1073741824) THEN 'better' ELSE 'worse' END AS change FROM a JOIN b USING (qid) WHERE coalesce(b.rank, 1073741824) <> coalesce(a.rank, 1073741824)""")
def run_compare(spark, sf_dir):
    """Which questions move when scores are divided by the number of terms met."""
    asked, docs = table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents")
    gold = C.quotes(asked, docs, "item_id", "doc_id").withColumnRenamed("item_id", "qid")
    scored = _scored(spark, sf_dir, _items(spark, sf_dir))
    open_ = S.capped(scored.withColumn("s", F.col("score") / (1 + F.col("n_hit"))), ["doc_id"], ["source"], 0, 10, "s")
    q = _questions(spark, sf_dir)
    a = E.first_rank(q, S.capped(scored, ["doc_id"], ["source"], 5, 10), gold, ["doc_id"])
    return E.compare_runs(a, E.first_rank(q, open_, gold, ["doc_id"]))


@query("""WITH r AS (SELECT l.doc_id, CASE WHEN lang IN ('en', 'de') THEN lang ELSE 'other' END AS kind, CASE WHEN quality = 1 AND toxic = 0 THEN 'right' WHEN quality = 1 THEN 'partial' WHEN toxic = 0 THEN 'wrong' ELSE 'error' END AS verdict, n_chars AS tokens FROM labels l JOIN documents d USING (doc_id))
SELECT coalesce(kind, 'all') AS kind, count(*) AS n, count(*) FILTER (WHERE verdict = 'right') AS n_right, count(*) FILTER (WHERE verdict = 'partial') AS n_partial, count(*) FILTER (WHERE verdict = 'wrong') AS n_wrong, count(*) FILTER (WHERE verdict = 'error') AS n_error,
round(100.0 * count(*) FILTER (WHERE verdict = 'right') / nullif(count(*) FILTER (WHERE verdict <> 'error'), 0), 6) AS pct_right, round(100.0 * count(*) FILTER (WHERE verdict = 'partial') / nullif(count(*) FILTER (WHERE verdict <> 'error'), 0), 6) AS pct_partial, round(100.0 * count(*) FILTER (WHERE verdict = 'wrong') / nullif(count(*) FILTER (WHERE verdict <> 'error'), 0), 6) AS pct_wrong, sum(tokens)::BIGINT AS tokens FROM r GROUP BY ROLLUP (kind)""")
def grade_report(spark, sf_dir):
    """Verdicts by kind, taken from labels."""
    verdict = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "right").when(F.col("quality") == 1, "partial").when(F.col("toxic") == 0, "wrong").otherwise("error")
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    return E.grade_report(rows.select(F.when(F.col("lang").isin("en", "de"), F.col("lang")).otherwise("other").alias("kind"), verdict.alias("verdict"), F.col("n_chars").alias("tokens")), ("right", "partial", "wrong", "error"))


@query()
def close_matches(spark, sf_dir):
    """Part names with their third or their first letter missing, and the names suggested for them."""
    names = table(spark, sf_dir, "part").select(F.lower("p_name").alias("name_lower")).distinct()
    third = F.concat(F.left("name_lower", F.lit(2)), F.expr("substring(name_lower, 4)"))
    asked = names.select(F.col("name_lower").alias("qid"), F.explode(F.array(third, F.expr("substring(name_lower, 2)"))).alias("name"))
    return L.suggestions(asked, names).select("qid", "name", F.array_join("suggested", ",").alias("suggested"))
