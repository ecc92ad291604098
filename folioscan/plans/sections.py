"""Queries: sections, passages and phrases over documents; outlines matched, nested and anchored over regions, nations and suppliers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioscan.functions import text as X
from folioscan.operators import outline as O
from folioscan.operators import passages as P
from folioscan.operators import search as S
from folioscan.operators import structure as T

from .registry import query, table
from .releases import _TOC, _toc

_FENCED = r"l AS (SELECT doc_id, line, pos, regexp_matches(line, '^\s*```') AS fence, sum(CASE WHEN regexp_matches(line, '^\s*```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) % 2 = 1 AS code FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos FROM documents))"


@query(rf"""WITH {_FENCED}, m AS (SELECT *, NOT regexp_matches(line, '\S') AND NOT code AS blank FROM l), g AS (SELECT *, sum(CASE WHEN blank THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM m),
b AS (SELECT doc_id, min(pos) AS p0, string_agg(line, chr(10) ORDER BY pos) AS block FROM g WHERE NOT blank GROUP BY doc_id, grp), f AS (SELECT *, regexp_replace(string_split(block, chr(10))[1], '^\s+', '') AS first FROM b)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY p0) - 1 AS n, CASE WHEN starts_with(first, '```') THEN 'code' WHEN starts_with(first, '#') THEN 'heading' WHEN regexp_matches(first, '^(?:[-*•]|\d+[.)])\s') THEN 'item' WHEN regexp_replace(block, '\s+$', '') LIKE '%:' THEN 'lead' ELSE 'text' END AS kind, md5(block) AS digest FROM f""")
def text_blocks(spark, sf_dir):
    """Blocks of documents between blank lines, and what they are."""
    rows = P.block_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], "text")
    return rows.select("doc_id", F.col("n").cast("long").alias("n"), "kind", F.md5("block").alias("digest"))


@query()
def passage_narrowing(spark, sf_dir):
    """Documents, their lines as paragraphs, cut to what answers the first line of theirs, where that is worth it."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"), F.substring_index("text", "\n", 1).alias("query"))
    shown = P.mapped(rows, ["doc_id"], ["text", "query"], "shown string", lambda text, asked: [(P.narrowed(text or "", asked or ""),)])
    return shown.filter("shown is not null").select("doc_id", F.length("shown").alias("n_chars"), F.md5("shown").alias("digest"))


@query()
def passage_ranks(spark, sf_dir):
    """Passages of documents, their lines as paragraphs, scored by the words of their first line."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"), F.substring_index("text", "\n", 1).alias("query"))
    return P.scored_rows(rows, ["doc_id"], "text", "query")


_SECTIONS = "c AS (SELECT doc_id AS chunk_id, lang AS collection, source AS slug, row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) - 1 AS ord, 'docs/' || source || '/sections/' || (doc_id % 1000) || '.md' AS file, doc_id % 3 = 0 AS cur, text FROM documents)"


@query(f"""WITH {_SECTIONS},
r AS (SELECT chunk_id AS request, CASE WHEN chunk_id % 2 = 0 THEN chunk_id END AS section_id, CASE WHEN chunk_id % 4 = 1 THEN file ELSE 'sections/' || (chunk_id % 1000) || '.md' END AS path, least(chunk_id % 6, 3) AS ctx FROM c),
i AS (SELECT request, ctx, c.collection, c.slug, c.ord FROM r JOIN c ON c.chunk_id = r.section_id),
f AS (SELECT *, row_number() OVER (PARTITION BY request ORDER BY (file = path) DESC, cur DESC, chunk_id) AS k FROM (SELECT request, ctx, path, c.* FROM r JOIN c ON c.file = path OR c.file LIKE '%/' || path WHERE section_id IS NULL)),
m AS (SELECT * FROM i UNION ALL SELECT request, ctx, collection, slug, ord FROM f WHERE k = 1)
SELECT request, c.chunk_id, c.ord = m.ord AS is_asked, md5(CASE WHEN length(text) > 40000 THEN left(text, 40000) || chr(10) || chr(10) || '[… cut at 40,000 characters …]' ELSE text END) AS digest FROM m JOIN c ON c.collection = m.collection AND c.slug = m.slug AND c.ord BETWEEN m.ord - ctx AND m.ord + ctx""")
def get_section(spark, sf_dir):
    """Documents as sections of their source, asked for by id, by their whole file or by its end, with what stands around them."""
    d = table(spark, sf_dir, "documents")
    n = F.row_number().over(Window.partitionBy("lang", "source").orderBy("doc_id")) - 1
    name = F.concat((F.col("doc_id") % 1000).cast("string"), F.lit(".md"))
    chunks = d.select(F.col("doc_id").alias("chunk_id"), F.col("lang").alias("collection"), F.col("source").alias("slug"), n.alias("ord"), F.concat(F.lit("docs/"), "source", F.lit("/sections/"), name).alias("file"), (F.col("doc_id") % 3 == 0).alias("is_current"), F.col("text").alias("body"))
    key = F.col("doc_id")
    path = F.when(key % 4 == 1, F.concat(F.lit(".\\docs\\"), "source", F.lit("\\sections\\"), name)).otherwise(F.concat(F.lit("/sections/"), name))
    asked = d.select(key.alias("request"), F.when(key % 2 == 0, key).alias("section_id"), path.alias("file"), F.lit(None).cast("string").alias("query"), (key % 6).cast("string").alias("context"))
    return P.sections(asked, chunks).select("request", "chunk_id", "is_asked", F.md5("shown").alias("digest"))


_W = r"regexp_extract_all(lower(text), '[0-9a-z]+')"
_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)


@query(rf"""WITH q AS (SELECT item_id AS qid, w, left(w[3], 3) IN ({_STOP}) AS no_2, w[4] IN ({_STOP}) AND w[5] IN ({_STOP}) AS no_3 FROM (SELECT item_id, {_W} AS w FROM benchmark)), d AS MATERIALIZED (SELECT doc_id, ' ' || array_to_string({_W}, ' ') || ' ' AS t FROM documents),
h AS (SELECT qid, doc_id, contains(t, ' ' || w[1] || ' ' || w[2] || ' ')::INT + (NOT no_2 AND contains(t, ' ' || left(w[3], 3)))::INT + (NOT no_3 AND contains(t, ' ' || w[4] || ' ' || w[5] || ' '))::INT AS n_hit, 3 - no_2::INT - no_3::INT AS n_terms FROM q, d)
SELECT * FROM h WHERE n_hit > 0""")
def phrase_prefix_match(spark, sf_dir):
    """Three terms of each item: two words as a phrase, the beginning of one, two joined by an underscore; how many each document holds."""
    w = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), X.ascii_words("text").alias("w"))
    at = lambda i: F.get("w", F.lit(i))
    asked = w.select("qid", F.concat(F.lit('"'), at(0), F.lit(" "), at(1), F.lit('" '), F.left(at(2), F.lit(3)), F.lit("* "), at(3), F.lit("_"), at(4)).alias("query"))
    return S.phrase_matches(asked, table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], "text")


@query()
def search_snippets(spark, sf_dir):
    """Twenty-eight words of each document around the words of its last line."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", X.words(F.substring_index("text", "\n", -1)).alias("terms"))
    return S.snippets(rows, "text", "terms").select("doc_id", "snippet")


_RANKS = f"{_TOC}, rk AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY page, idx) AS rank FROM toc), sp AS (SELECT a.*, coalesce((SELECT min(b.rank) FROM rk b WHERE b.doc = a.doc AND b.rank > a.rank AND b.level <= a.level), count(*) OVER (PARTITION BY a.doc) + 1) AS end_rank FROM rk a)"


@query(f"WITH {_RANKS} SELECT doc, idx, rank, end_rank FROM sp")
def span_ranks(spark, sf_dir):
    """Places of outline entries in order of page, and where each ends."""
    return O.ranked_spans(_toc(spark, sf_dir), ["doc"]).select("doc", "idx", "rank", "end_rank")


@query(f"""WITH {_RANKS}, p AS (SELECT doc, idx, title AS o, lead(title) OVER (PARTITION BY doc ORDER BY idx) AS i FROM sp), k AS (SELECT doc, idx, lower(o) AS "outer", lower(i) AS "inner" FROM p WHERE i IS NOT NULL)
SELECT k.doc, k.idx, bool_or(CASE WHEN a.rank IS NULL OR b.rank IS NULL THEN true ELSE a.rank < b.rank AND b.rank < a.end_rank END) AS nests FROM k LEFT JOIN sp a ON a.doc = k.doc AND lower(a.title) = "outer" AND a.idx % 7 <> 0 LEFT JOIN sp b ON b.doc = k.doc AND lower(b.title) = "inner" AND b.idx % 7 <> 0 GROUP BY ALL""")
def span_nesting(spark, sf_dir):
    """Neighbouring entries of an outline: whether the first encloses the second; every seventh has no pages."""
    spans = O.ranked_spans(_toc(spark, sf_dir), ["doc"]).withColumn("title_key", F.lower("title"))
    pairs = spans.select("doc", F.col("idx").alias("pair"), F.col("title_key").alias("outer"), F.lead("title_key").over(Window.partitionBy("doc").orderBy("idx")).alias("inner")).filter("inner is not null")
    known = spans.withColumn("rank", F.when(F.col("idx") % 7 != 0, F.col("rank")))
    return O.nested(pairs, known, ["doc"]).select("doc", F.col("pair").alias("idx"), "nests")


_NAMED = "nm AS (SELECT doc, idx, level, page, CASE WHEN level > 1 AND idx % 3 = 0 THEN 'Overview' WHEN level > 1 THEN 'Notes on ' || title ELSE title END AS title FROM toc)"
_CHAINS = "ch AS (SELECT a.doc, a.idx, b.idx AS i, b.level, b.title FROM nm a JOIN nm b ON b.doc = a.doc AND b.idx <= a.idx AND b.level <= a.level AND (b.level < a.level OR b.idx = a.idx) AND NOT EXISTS (SELECT 1 FROM nm c WHERE c.doc = a.doc AND c.idx > b.idx AND c.idx <= a.idx AND c.level <= b.level))"


def _named(spark, sf_dir):
    title = F.when((F.col("level") > 1) & (F.col("idx") % 3 == 0), "Overview").when(F.col("level") > 1, F.concat(F.lit("Notes on "), "title")).otherwise(F.col("title"))
    return _toc(spark, sf_dir).withColumn("title", title)


@query(f"""WITH {_TOC}, {_NAMED}, {_CHAINS}, up AS (SELECT doc, idx, string_agg(title, ' › ' ORDER BY level, i) FILTER (WHERE i <> idx) AS up FROM ch GROUP BY doc, idx)
SELECT doc, idx AS ord, 'Manual ' || doc || CASE WHEN idx % 10 <> 9 AND up IS NOT NULL THEN ' › ' || up ELSE '' END AS breadcrumb FROM up""")
def in_order_breadcrumbs(spark, sf_dir):
    """Chunks that open with the titles of their entries, some of which repeat and are told apart by their order; a tenth have no heading; passing mentions further down change nothing."""
    toc = _named(spark, sf_dir)
    head = F.when(F.col("idx") % 10 == 9, "No heading here").when(F.col("idx") % 2 == 0, F.concat(F.lit("## **"), "title", F.lit("**"))).otherwise(F.concat(F.lit("**"), "title", F.lit("**")))
    title = F.concat(F.lit("Manual "), F.col("doc").cast("string"))
    body = F.concat_ws("\n", F.concat(F.lit("*"), title, F.lit("*")), F.lit(""), head, F.lit("text"), F.lit("```"), F.lit("# Overview"), F.lit("```"), F.lit("# Manual"))
    chunks = toc.select("doc", F.col("idx").alias("ord"), title.alias("title"), body.alias("body"))
    return O.breadcrumbs(chunks, toc, ["doc"]).select("doc", "ord", "breadcrumb")


@query(f"""WITH {_TOC}, {_NAMED}, {_CHAINS}, full_ AS (SELECT doc, idx, string_agg(title, ' › ' ORDER BY level, i) AS chain FROM ch GROUP BY doc, idx), pl AS (SELECT doc, idx, page + 1 AS page FROM nm UNION ALL SELECT doc, -idx, page - 1 FROM nm)
SELECT pl.doc, pl.idx, (SELECT chain FROM nm JOIN full_ USING (doc, idx) WHERE nm.doc = pl.doc AND nm.page <= pl.page ORDER BY nm.page DESC, nm.idx DESC LIMIT 1) AS chain FROM pl""")
def headings_in_force(spark, sf_dir):
    """The headings in force one page after and one page before each entry."""
    toc = _named(spark, sf_dir).withColumn("y", F.col("idx"))
    after = toc.select("doc", "idx", (F.col("page") + 1).alias("page"), F.lit(0).alias("y"))
    before = toc.select("doc", (-F.col("idx")).alias("idx"), (F.col("page") - 1).alias("page"), F.lit(99_999).alias("y"))
    return O.chain_at(after.withColumn("y", F.lit(99_999)).union(before), toc, ["doc"]).select("doc", "idx", F.array_join("chain", X.CRUMB).alias("chain"))


@query(f"""WITH {_TOC}, {_NAMED}, s AS (SELECT a.*, (SELECT b.page FROM nm b WHERE b.doc = a.doc AND b.level <= a.level AND (b.page > a.page OR (b.page = a.page AND b.idx > a.idx)) ORDER BY b.page, b.idx LIMIT 1) AS end_page FROM nm a),
c AS (SELECT doc, idx AS ord, lower(title) AS k, page + (idx % 3) * 400 AS ps, page + (idx % 3) * 400 + 1 AS pe FROM nm),
h AS (SELECT c.doc, c.ord, arg_min(s.idx, struct_pack(d := abs(s.page - ps), i := s.idx)) AS i FROM c JOIN s ON s.doc = c.doc AND lower(s.title) = c.k AND s.page <= pe AND (s.end_page IS NULL OR s.end_page >= ps) GROUP BY ALL)
SELECT c.doc, c.ord, coalesce(h.i, CASE WHEN c.ord % 2 = 0 THEN c.ord END) AS entry, CASE WHEN h.i IS NOT NULL THEN 'title' WHEN c.ord % 2 = 0 THEN 'position' END AS how FROM c LEFT JOIN h USING (doc, ord)""")
def heading_anchors(spark, sf_dir):
    """Chunks under titles that repeat: the entry of the title whose pages overlap theirs and is nearest, else where they stand."""
    toc = _named(spark, sf_dir)
    spans = T.toc_spans(toc, ["doc"]).withColumn("title_key", F.lower("title"))
    at = F.col("page") + (F.col("idx") % 3) * 400
    chunks = toc.select("doc", F.col("idx").alias("ord"), F.lower("title").alias("title_key"), at.alias("page_start"), (at + 1).alias("page_end"))
    back = toc.filter("idx % 2 = 0").select("doc", F.col("idx").alias("ord"), F.col("idx").alias("entry"))
    return O.anchored(chunks, spans, ["doc"], back).select("doc", "ord", "entry", "how")


@query(f"""WITH {_TOC}, e AS (SELECT *, page * 300 AS ps, CASE WHEN idx % 3 <> 0 THEN page * 300 + (idx * 9973) % 60000 END AS h FROM toc WHERE level <= 2),
f AS (SELECT *, max(CASE WHEN h < ps + 40000 THEN h ELSE ps END) OVER (PARTITION BY doc ORDER BY page, idx) AS start FROM e), n AS (SELECT *, lead(start) OVER (PARTITION BY doc ORDER BY page, idx) AS nxt FROM f)
SELECT doc, idx, title, start, coalesce(nxt, 90000000) AS stop FROM n WHERE level = 2""")
def entry_regions(spark, sf_dir):
    """Suppliers as entries of a reference: where each begins, by its heading line where that is near its page, and ends."""
    toc = _toc(spark, sf_dir)
    pages = toc.select("doc", "page", (F.col("page") * 300).alias("start")).distinct()
    heads = toc.filter("idx % 3 <> 0").select("doc", X.norm_title("title").alias("key"), (F.col("page") * 300 + (F.col("idx") * 9973) % 60000).alias("offset"))
    sizes = toc.select("doc").distinct().withColumn("size", F.lit(90_000_000))
    return O.entry_regions(toc, pages, heads, sizes, ["doc"], 2)


_PIECES = "p AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) - length(text) AS a, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS b, turn % 5 = 3 AS opens FROM conversations)"


def _pieces(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    b = F.sum(F.length("text")).over(Window.partitionBy("conv_id").orderBy("turn"))
    return c.select("conv_id", "turn", (b - F.length("text")).alias("a"), b.alias("b"), (F.col("turn") % 5 == 3).alias("opens"))


@query(f"""WITH RECURSIVE {_PIECES}, g AS (SELECT conv_id, k, turn, a AS start, b AS stop, 0 AS no FROM p WHERE k = 1 UNION ALL SELECT p.conv_id, p.k, p.turn, CASE WHEN p.b - g.start > 1200 THEN p.a ELSE g.start END, p.b, g.no + (p.b - g.start > 1200)::INT FROM g JOIN p ON p.conv_id = g.conv_id AND p.k = g.k + 1)
SELECT conv_id, no, min(turn) AS first, min(start)::BIGINT AS start, max(stop)::BIGINT AS stop, count(*) AS n FROM g GROUP BY conv_id, no""")
def greedy_pack(spark, sf_dir):
    """Turns of a conversation as pieces of a chapter, packed up to 1,200 characters."""
    return O.packed(_pieces(spark, sf_dir), ["conv_id"], "turn", "a", "b", 1200)


@query(f"""WITH RECURSIVE {_PIECES}, g AS (SELECT conv_id, k, turn, a AS start, b AS stop, 0 AS no FROM p WHERE k = 1 UNION ALL SELECT p.conv_id, p.k, p.turn, CASE WHEN c.cut THEN p.a ELSE g.start END, p.b, g.no + c.cut::INT FROM g JOIN p ON p.conv_id = g.conv_id AND p.k = g.k + 1, LATERAL (SELECT p.b - g.start > 1200 OR g.stop - g.start >= 300 OR p.opens AS cut) c)
SELECT conv_id, no, min(turn) AS first, min(start)::BIGINT AS start, max(stop)::BIGINT AS stop, count(*) AS n FROM g GROUP BY conv_id, no""")
def small_pack(spark, sf_dir):
    """Turns joined until they have 300 characters, never across one that opens a section."""
    return O.packed(_pieces(spark, sf_dir), ["conv_id"], "turn", "a", "b", 1200, 300, "opens")
