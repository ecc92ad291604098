"""Queries: figures linked to sections and captions over documents and lines, scopes and exclusions of questions, what carries over, totals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioscan.operators import catalog_tables as C
from folioscan.operators import evaluate as E
from folioscan.operators import figures as G
from folioscan.operators import placement as P

from .registry import query, table
from .releases import _RELEASES, _releases


def linked_inputs(spark, sf_dir):
    """Documents as sections of their source, every second headed by a caption; a figure for each, whose context is the document's first line."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    n = F.row_number().over(Window.partitionBy("lang", "source").orderBy("doc_id")) - 1
    first = F.substring_index("text", "\n", 1)
    title = F.concat(F.lit("Figure "), (F.col("doc_id") % 50).cast("string"), F.lit(". "), first)
    even = F.col("doc_id") % 2 == 0
    own = d.select("lang", "source", "doc_id", n.alias("ord"), F.when(even, F.concat(F.lit("**"), title, F.lit("**\n"), "text")).otherwise(F.col("text")).alias("text"), first.alias("context"), F.when(even & (F.col("doc_id") % 3 != 0), title).alias("caption"))
    sections = own.select("lang", "source", "ord", "text", F.when(F.col("doc_id") % 5 < 2, F.col("ord")).alias("page_start"), F.when(F.col("doc_id") % 5 < 2, F.col("ord") + F.col("doc_id") % 2).alias("page_end"))
    return sections, own.select("lang", "source", F.col("ord").alias("figure"), F.col("ord").alias("page"), "caption", "context")


@query()
def figure_links(spark, sf_dir):
    """The document of a source that each figure belongs to, and by what."""
    return G.links(*linked_inputs(spark, sf_dir), ["lang", "source"])


@query()
def figure_link_agreement(spark, sf_dir):
    """How often pages and paragraphs say of a source's figures what captions say."""
    return G.agreement(G.links(*linked_inputs(spark, sf_dir), ["lang", "source"]), ["lang", "source"])


def page_boxes(spark, sf_dir):
    """Lines of orders as boxes of a page: returned ones are pictures, accepted ones caption boxes, the others texts."""
    x, y = (F.col("l_partkey") % 7) * 40, (F.col("l_suppkey") % 9) * 50
    kind = F.when(F.col("l_returnflag") == "R", "picture").when(F.col("l_returnflag") == "A", "caption").otherwise("text")
    words = F.when(F.col("l_quantity") % 5 == 0, F.lit("Figure 3 shows parts")).otherwise(F.concat(F.lit("Fig. "), "l_suppkey", F.lit(". Part"), F.col("l_partkey").cast("string")))
    at = [c.cast("double") for c in (x, y, x + 150, y + 30 + (F.col("l_partkey") % 3) * 20)]
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(*[F.min(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_returnflag", "l_quantity")])
    return rows.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("box"), kind.alias("kind"), *[c.alias(n) for c, n in zip(at, ("x0", "y0", "x1", "y1"), strict=True)], F.when(kind != "picture", F.array(words, F.lit("and more"))).alias("lines"))


@query()
def caption_assignment(spark, sf_dir):
    """The caption of every picture among an order's lines, and the text above it."""
    return G.captions_of(page_boxes(spark, sf_dir), ["page"])


@query("""WITH s AS (SELECT doc_id, lang, source, doc_id % 50 AS file FROM documents), a AS (SELECT DISTINCT CASE WHEN quality = 1 THEN lang END AS lang, source, CASE WHEN toxic = 0 THEN (doc_id % 50 + quality) END AS file FROM labels JOIN documents USING (doc_id))
SELECT doc_id FROM s WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.source = s.source AND a.file = s.file AND (a.lang IS NULL OR a.lang = s.lang))""")
def unanswered_sections(spark, sf_dir):
    """Documents as sections of their source to which no labelled one, taken as an answer, points; bad ones stand for every language, toxic ones are quotes."""
    d = table(spark, sf_dir, "documents")
    met = table(spark, sf_dir, "labels").join(d, "doc_id")
    answers = met.select(F.when(F.col("quality") == 1, F.col("lang")).alias("collection"), F.col("source").alias("slug"), F.when(F.col("toxic") == 0, F.col("doc_id") % 50 + F.col("quality")).alias("file"))
    sections = d.select("doc_id", F.col("lang").alias("collection"), F.col("source").alias("slug"), (F.col("doc_id") % 50).alias("file"))
    return E.unanswered(sections, answers).select("doc_id")


@query(f"""WITH {_RELEASES}, q AS (SELECT slug AS id, CASE WHEN slug % 4 < 3 THEN doc_id END AS doc_id, CASE WHEN slug % 2 = 0 THEN version END AS version, CASE WHEN slug % 2 = 0 THEN k END AS wk, upper(CASE WHEN version LIKE 'v%' THEN replace(version[2:], '_', '.') ELSE version END) AS name FROM r),
m AS (SELECT q.*, r.k, r.slug, r.later, upper(CASE WHEN r.version LIKE 'v%' THEN replace(r.version[2:], '_', '.') ELSE r.version END) = q.name OR coalesce(r.k = q.wk, false) AS same FROM q JOIN r USING (doc_id) WHERE q.version <> ''),
e AS (SELECT id, arg_min(slug, struct_pack(u := k IS NOT NULL, k := k, s := slug)) FILTER (WHERE same) AS exact, max(struct_pack(k := k, slug := slug, later := later)) FILTER (WHERE k < wk) AS b FROM m GROUP BY id),
t AS (SELECT *, max(k) OVER (PARTITION BY doc_id) AS top, count(*) OVER (PARTITION BY doc_id) AS n, count(k) OVER (PARTITION BY doc_id) AS known FROM r), u AS (SELECT *, count(*) FILTER (WHERE k = top) OVER (PARTITION BY doc_id) AS tied FROM t),
c AS (SELECT doc_id, slug AS now FROM u WHERE n = 1 OR (known = n AND tied = 1 AND k = top)),
f AS (SELECT q.id, q.doc_id, q.version, CASE WHEN coalesce(q.version, '') = '' THEN c.now WHEN exact IS NOT NULL THEN exact WHEN b.later THEN b.slug END AS scope_slug, b IS NOT NULL AS below FROM q LEFT JOIN e USING (id) LEFT JOIN c ON c.doc_id = q.doc_id)
SELECT id, scope_slug, CASE WHEN doc_id IS NULL THEN CASE WHEN coalesce(version, '') <> '' THEN 'version' END WHEN scope_slug IS NULL THEN CASE WHEN coalesce(version, '') <> '' AND below THEN 'not covered' ELSE 'no edition' END END AS error FROM f""")
def question_scopes(spark, sf_dir):
    """The one release that a question about a customer's orders is searched in; every fourth question names no customer, every second a version."""
    docs = _releases(spark, sf_dir)
    asked = docs.select(F.col("slug").alias("id"), "collection", F.when(F.col("slug") % 4 < 3, F.col("doc_id")).alias("document"), F.when(F.col("slug") % 2 == 0, F.col("version")).alias("version"))
    return E.scopes(asked, docs).select("id", "scope_slug", F.when(F.col("scope_error").contains("needs"), "version").otherwise(F.col("scope_error")).alias("error"))


_FIGURES = "o AS (SELECT o_custkey AS doc, o_orderkey AS id, 'ocr ' || o_orderkey AS ocr, o_orderkey % 2 AS box, o_custkey % 2 AS was, o_orderstatus AS art, CASE WHEN o_orderpriority LIKE '1%' THEN NULL WHEN o_orderpriority LIKE '2%' THEN 'X' ELSE o_orderstatus END AS old_art FROM orders)"


def _figures(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    art = F.when(F.col("o_orderpriority").startswith("2"), "X").when(~F.col("o_orderpriority").startswith("1"), F.col("o_orderstatus"))
    doc, key = F.col("o_custkey").alias("doc"), F.col("o_orderkey")
    new = o.select(doc, key.alias("id"), F.array(key % 2).alias("bbox"), F.col("o_orderstatus").alias("fingerprint"), F.concat((key * 2).cast("string"), F.lit(".png")).alias("file"))
    old = o.select(doc, key.alias("id"), F.array(F.col("o_custkey") % 2).alias("bbox"), art.alias("fingerprint"), F.concat(key.cast("string"), F.lit(".png")).alias("file"), F.concat(F.lit("ocr "), key.cast("string")).alias("ocr"))
    return new, old


@query(f"WITH {_FIGURES} SELECT doc, id, CASE WHEN box = was AND (old_art IS NULL OR old_art = art) THEN ocr END AS ocr FROM o")
def figure_carry_over(spark, sf_dir):
    """Orders as figures read again: the earlier reading where box and art are the same."""
    new, old = _figures(spark, sf_dir)
    return G.carried(new, old, ["doc"]).select("doc", "id", "ocr")


@query(f"WITH {_FIGURES} SELECT doc, id || '.png' AS file FROM o EXCEPT SELECT doc, (id * 2) || '.png' FROM o")
def stale_figures(spark, sf_dir):
    """Files of orders as figures that the new ones don't have."""
    new, old = _figures(spark, sf_dir)
    return G.stale_files(old, new, ["doc"])


@query("SELECT lang AS collection, source AS slug, count(*) AS n, CAST(grouping(lang, source) AS BIGINT) AS level FROM documents GROUP BY ROLLUP (lang, source)")
def chunk_totals(spark, sf_dir):
    """Documents a source, a language and in all."""
    return C.chunk_totals(table(spark, sf_dir, "documents").select(F.col("lang").alias("collection"), F.col("source").alias("slug")))


@query("""WITH c AS (SELECT n_nationkey AS k, n_name, n_regionkey AS r, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n FROM nation)
SELECT k AS n, rpad(n_name, 20, ' ') || '  ' || lpad(r::VARCHAR, 6, ' ') || '  ' || lpad(n::VARCHAR, 9, ' ') AS line FROM c UNION ALL SELECT max(k) + 1, rtrim(rpad('total', 20, ' ') || '  ' || rpad('', 6, ' ')) || repeat(' ', 25) || lpad(sum(n)::VARCHAR, 9, ' ') FROM c""")
def nation_report(spark, sf_dir):
    """A report of fixed width: nations, their region and customers, and the sum."""
    per = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("customers"))
    rows = table(spark, sf_dir, "nation").join(per, "n_nationkey", "left").fillna(0, ["customers"])
    return C.report_lines(rows, {"n_name": 20, "n_regionkey": 6, "customers": 9}, "n_nationkey", ["customers"])


PAGE_CHARS = 600


def placement_inputs(spark, sf_dir):
    """Lines of documents as chunks, pieces of a fixed length of them as pages."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chunks = d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "text"))
    at = F.sequence(F.lit(0), F.greatest(F.floor((F.length("text") - 1) / PAGE_CHARS), F.lit(0)).cast("int"))
    pages = d.select("doc_id", "text", F.explode(at).alias("p")).select("doc_id", (F.col("p") + 1).alias("page"), F.substring("text", F.col("p") * PAGE_CHARS + 1, F.lit(PAGE_CHARS)).alias("text"))
    return chunks, pages


@query()
def chunk_page_placement(spark, sf_dir):
    """The pages that the lines of each document are on, found by their words."""
    return P.page_placement(*placement_inputs(spark, sf_dir), ["doc_id"])


@query()
def lineage_merge(spark, sf_dir):
    """Turns of conversations as chunks, whose chain is the role under every third turn, merged up to a length."""
    c = table(spark, sf_dir, "conversations").groupBy("conv_id", "turn").agg(F.min_by("role", "text").alias("role"), F.min("text").alias("text"))
    third = F.floor(F.col("turn") / 3).cast("string")
    rows = c.select("conv_id", F.col("turn").alias("ord"), F.col("role").alias("heading"), "text", F.when(F.col("turn") % 3 == 0, F.array(third)).otherwise(F.array(third, F.col("role"))).alias("ancestors"), F.when(F.col("turn") % 4 == 3, "page").otherwise("anchored").alias("confidence"), F.col("turn").alias("page_start"), (F.col("turn") + 1).alias("page_end"))
    return P.merged_by_lineage(rows, ["conv_id"], 1500)
