"""Queries: names, versions, captions, replies and covers, over the star-schema tables, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscan.functions import labels as N
from folioscan.functions import text as X
from folioscan.operators import covers as V

from .registry import query, table
from .releases import _RELEASES, _releases


@query(f"""WITH {_RELEASES}, s AS (SELECT slug, version, 'guide-' || (slug % 50) || '-' || regexp_replace(lower(version), '[^a-z0-9]+', '-', 'g') AS own, 'manual-' || (slug % 50) || '-20' || lpad((slug % 30)::VARCHAR, 2, '0') || '-' || (slug % 4 + 1) AS other FROM r)
SELECT slug, 'guide-' || (slug % 50) AS doc_id, 'manual-' || (slug % 50) AS other_id, 'manual-' || (slug % 50) || '-' || regexp_replace(lower(version), '[^a-z0-9]+', '-', 'g') AS folder FROM s""")
def default_names(spark, sf_dir):
    """Slugs that end in their own release or in another one: the manual's name without it, and the folder of a new edition."""
    r = _releases(spark, sf_dir)
    n = (F.col("slug") % 50).cast("string")
    own = F.concat(F.lit("guide-"), n, F.lit("-"), X.slug("version"))
    other = F.concat(F.lit("manual-"), n, F.lit("-20"), F.lpad((F.col("slug") % 30).cast("string"), 2, "0"), F.lit("-"), (F.col("slug") % 4 + 1).cast("string"))
    rows = r.select("slug", "version", own.alias("own"), other.alias("other"))
    return rows.select("slug", N_doc("own", "version").alias("doc_id"), N_doc("other", F.lit(None).cast("string")).alias("other_id"), X.default_slug("other", "version").alias("folder"))


N_doc = X.default_doc_id


@query(f"""WITH {_RELEASES}, e AS (SELECT slug, doc_id, version, later, slug % 5 AS ps, slug % 7 AS pe, CASE WHEN slug % 3 = 0 THEN 'e' || slug END AS entity FROM r)
SELECT slug, CASE WHEN slug % 11 = 0 THEN 's' || slug WHEN later THEN version || ' and later' ELSE version END AS edition, concat_ws(' · ', 'Doc ' || doc_id, CASE WHEN slug % 2 = 0 THEN 'A › B' END, CASE WHEN ps > 0 THEN CASE WHEN pe = 0 OR pe = ps THEN 'p. ' || ps ELSE 'pp. ' || ps || '–' || pe END END, '`' || entity || '`') AS cite FROM e""")
def citations(spark, sf_dir):
    """Editions by name, and sections by document, breadcrumb, pages and entry, as far as they have them."""
    key = F.col("slug")
    none = F.lit(None).cast("string")
    start, end = F.nullif(key % 5, F.lit(0)), F.nullif(key % 7, F.lit(0))
    cite = N.citation(F.concat(F.lit("Doc "), F.col("doc_id").cast("string")), F.when(key % 2 == 0, "*A › B*"), start, end, F.when(key % 3 == 0, F.concat(F.lit("e"), key.cast("string"))))
    name = N.edition_name(F.when(key % 11 != 0, F.col("version")), "version_later", F.concat(F.lit("s"), key.cast("string")))
    return _releases(spark, sf_dir).select("slug", F.coalesce(name, none).alias("edition"), cite.alias("cite"))


@query("""SELECT p_partkey, greatest(1, least(40, CASE WHEN p_size % 5 = 0 THEN 10 ELSE p_size * 3 - 20 END)) AS lim, p_size % 3 <> 0 AS hit, CASE WHEN p_size % 2 = 0 AND p_size % 4 <> 0 THEN '`version` needs `document`: a release means nothing without a manual.' END AS error FROM part""")
def argument_guards(spark, sf_dir):
    """Arguments of calls: limits as text within bounds, files by the end of their path, versions that need a document."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_size")
    asked = F.when(n % 5 == 0, "many").otherwise((n * 3 - 20).cast("string"))
    name = F.concat(F.lit("100%_"), F.col("p_partkey").cast("string"), F.lit(".md"))
    path = F.when(n % 3 == 1, F.concat(F.lit("/sections\\"), name)).when(n % 3 == 2, name).otherwise(F.concat(F.lit("00%_"), F.col("p_partkey").cast("string"), F.lit(".md")))
    return p.select("p_partkey", N.clamped(asked, 10, 1, 40).cast("long").alias("lim"), N.ends_in_path(F.concat(F.lit("docs/sections/"), name), path).alias("hit"), N.needs_document(F.when(n % 2 == 0, "2026.1"), F.when(n % 4 == 0, "guide")).alias("error"))


@query("""WITH c AS (SELECT p_partkey AS id, p_size % 6 AS k, p_name AS name FROM part)
SELECT id, k IN (0, 1, 3, 5) AS is_caption, CASE k WHEN 0 THEN 'Figure 5-' || id || '. ' || name WHEN 1 THEN 'Fig. ' || id || ' ' || upper(name) WHEN 2 THEN 'Figure ' || id || ' shows ' || name WHEN 3 THEN 'Figure A' || id || ': ' || name WHEN 4 THEN 'A figure of ' || name ELSE 'FIGURE ' || id END AS caption, k <> 4 AND k <> 2 AS alike FROM c""")
def figure_captions(spark, sf_dir):
    """Lines about parts as captions, sentences that cite one and bare labels: what is a caption, its text, and whether a longer line has the same."""
    k, name, n = F.col("p_size") % 6, F.col("p_name"), F.col("p_partkey").cast("string")
    first = F.when(k == 0, F.concat(F.lit("Figure 5-"), n, F.lit(". "), name)).when(k == 1, F.concat(F.lit("Fig. "), n, F.lit(" "), F.upper(name))).when(k == 2, F.concat(F.lit("Figure "), n, F.lit(" shows "), name)).when(k == 3, F.concat(F.lit("Figure A"), n, F.lit(":"))).when(k == 4, F.concat(F.lit("A figure of "), name)).otherwise(F.concat(F.lit("FIGURE "), n))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), k.alias("k"), F.when(k == 3, F.array(first, name)).otherwise(F.array(first)).alias("lines"))
    rows = rows.withColumn("caption", N.caption_text("lines"))
    longer = F.when(F.col("k").isin(4, 2), F.lit("something else altogether here")).otherwise(F.concat(N.caption_key(F.concat(F.lit("<b>"), "caption", F.lit("</b>"))), F.when(F.col("k").isin(0, 3), " seen from above").otherwise("")))
    return rows.select("id", N.is_caption(F.get("lines", F.lit(0))).alias("is_caption"), "caption", N.same_caption(N.caption_key("caption"), longer).alias("alike"))


@query("""SELECT conv_id, turn, CASE (conv_id + turn) % 5 WHEN 0 THEN 'correct' WHEN 1 THEN 'partial' WHEN 2 THEN 'wrong' END AS verdict, CASE (conv_id + turn) % 5 WHEN 0 THEN 'r' || turn WHEN 1 THEN '' WHEN 2 THEN 'because' WHEN 3 THEN 'no verdict: ' || left(text, 200) ELSE 'no verdict: {"verdict": "perfect"}' END AS reason FROM conversations""")
def grader_verdicts(spark, sf_dir):
    """Replies of a grader: JSON alone, in a sentence, in a fence, no verdict, and one that is none of the three."""
    k = (F.col("conv_id") + F.col("turn")) % 5
    reply = F.when(k == 0, F.concat(F.lit('{"verdict": " Correct", "reason": "r'), F.col("turn").cast("string"), F.lit('"}'))).when(k == 1, "My verdict: **Partial** I think").when(k == 2, '```json\n{"reason": " because ", "verdict": "WRONG"}\n```').when(k == 3, F.col("text")).otherwise('{"verdict": "perfect"}')
    own = N.verdict(reply)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", own["verdict"].alias("verdict"), own["reason"].alias("reason"))


@query("""WITH t AS (SELECT doc_id, text, length(text) AS n FROM documents), o AS (SELECT doc_id, text, n, unnest(generate_series(0, greatest(least(600, n - least(40, n)), 0), 20)) AS "offset" FROM t)
SELECT doc_id, "offset", substr(text, "offset" + 1, least(40, n)) AS from_start, substr(text, n - "offset" - least(40, n) + 1, least(40, n)) AS from_end FROM o""")
def text_probes(spark, sf_dir):
    """Probes of documents from both ends."""
    both = F.arrays_zip(N.probes("text").alias("a"), N.probes("text", True).alias("b"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(both).alias("p")).select("doc_id", F.col("p.a.offset").cast("long").alias("offset"), F.col("p.a.probe").alias("from_start"), F.col("p.b.probe").alias("from_end"))


@query("""WITH n AS (SELECT n_nationkey AS id, n_name AS name FROM nation), s AS (SELECT s_nationkey AS id, s_suppkey AS page, 'Software Version 2026.' || (s_suppkey % 3) || ' ' || CASE WHEN s_suppkey % 4 = 0 THEN 'other words' ELSE n_name || CASE WHEN s_suppkey % 4 = 1 THEN ' Guide' ELSE ' v2 ' || s_suppkey END END AS line FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT id, round(avg(CASE WHEN page % 4 IN (2, 3) THEN 1.0 ELSE 0.0 END), 6) AS share, avg(CASE WHEN page % 4 IN (2, 3) THEN 1.0 ELSE 0.0 END) >= 0.3 AS accepted FROM s GROUP BY id""")
def running_titles(spark, sf_dir):
    """Nations as titles of manuals, suppliers as their pages, some of which have the title as a line beside versions and page numbers."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    k = F.col("s_suppkey") % 4
    line = F.concat(F.lit("Software Version 2026."), (F.col("s_suppkey") % 3).cast("string"), F.lit(" "), F.when(k == 0, "other words").when(k == 1, F.concat("n_name", F.lit(" Guide"))).otherwise(F.concat("n_name", F.lit(" v2 "), F.col("s_suppkey").cast("string"))))
    pages = s.select(F.col("s_nationkey").alias("id"), F.col("s_suppkey").alias("page"), F.concat(F.lit("Some text\n"), line).alias("text"))
    titles = s.select(F.col("s_nationkey").alias("id"), F.col("n_name").alias("title")).distinct()
    return V.running_share(pages, titles, ["id"], sample=None).select("id", "share", "accepted")


@query(f"""WITH {_RELEASES}, c AS (SELECT slug, slug % 6 AS k, 'Y-20' || lpad((slug % 20)::VARCHAR, 2, '0') || '.03' AS v FROM r)
SELECT slug, CASE WHEN k IN (0, 1, 4) THEN v END AS version, CASE WHEN k IN (1, 5) THEN true ELSE false END AS later, CASE k WHEN 2 THEN 'the first pages name more than one version' WHEN 3 THEN 'no version on the first pages' WHEN 5 THEN 'the cover and the file name disagree' ELSE '' END AS note FROM c""")
def cover_versions(spark, sf_dir):
    """First pages that name a release once, with "and later", twice, not at all, twice the same, or another than the file's name does."""
    key = F.col("slug")
    k, y = key % 6, F.lpad((key % 20).cast("string"), 2, "0")
    v = F.concat(F.lit("Y-20"), y, F.lit(".03"))
    text = F.when(k == 0, F.concat(F.lit("Guide\nVersion "), v, F.lit(", March"))).when(k == 1, F.concat(F.lit("Guide\nVersion "), v, F.lit(" and later"))).when(k == 2, F.concat(F.lit("Version "), v, F.lit("\nSoftware Version 2035.1"))).when(k == 3, "No release here, only 2026").when(k == 4, F.concat(v, F.lit("\nSoftware Version 20"), y, F.lit(".3"))).otherwise(F.concat(F.lit("Version "), v, F.lit(" and later")))
    name = F.when(k == 4, F.concat(F.lit("ug_20"), y, F.lit("_3_001.pdf"))).when(k == 5, "ug_1999_x_2000.1.pdf").otherwise("guide.pdf")
    rows = _releases(spark, sf_dir).select("slug", F.lit(1).alias("page"), text.alias("text"), F.when((k == 5) & (key % 20 == 0), "ug_2000.1.pdf").otherwise(name).alias("file"))
    return V.covers(rows, ["slug"]).select("slug", "version", "later", "note")


@query("""WITH p AS (SELECT r_regionkey AS doc, s_suppkey % 37 AS page FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey), c AS (SELECT doc, page, count(*) AS n FROM p GROUP BY ALL), a AS (SELECT doc, sum(n) AS n_toc, count(*) AS n_starts, count(*) FILTER (WHERE n >= 2) AS multi, max(page) + 1 AS n_pages FROM c GROUP BY doc)
SELECT doc, round(n_toc / n_pages, 6) AS density, round(multi / n_starts, 6) AS shared, CASE WHEN n_toc / n_pages < 0.5 THEN 'low' WHEN n_toc / n_pages < 1 THEN 'moderate' ELSE 'high' END AS anchoring, CASE WHEN multi / n_starts < 0.1 THEN 'strong' WHEN multi / n_starts < 0.4 THEN 'good' ELSE 'weak' END AS fallback, doc % 2 = 0 AS has_text FROM a""")
def preflight_bands(spark, sf_dir):
    """Regions as manuals, suppliers as outline entries on pages: how dense the outline is, how many entries share a page, whether pages have text."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    toc = s.select(F.col("n_regionkey").alias("doc"), (F.col("s_suppkey") % 37).alias("page"))
    sizes = toc.groupBy("doc").agg((F.max("page") + 1).alias("n_pages"))
    text = sizes.select("doc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pages") - 1)).alias("page")).select("doc", "page", F.repeat(F.lit("x"), F.when(F.col("doc") % 2 == 0, 150).otherwise(50)).alias("text"))
    return V.preflight(toc, text, sizes, ["doc"])


@query("""WITH f AS (SELECT l_suppkey AS doc, l_orderkey AS id, l_linenumber AS fp, (l_partkey % 4) * 40 AS x, CASE WHEN l_orderkey % 9 = 0 THEN 'c' END AS caption FROM lineitem), s AS (SELECT *, count(*) OVER (PARTITION BY doc, x, fp) AS n FROM f)
SELECT doc, count(*) AS n_figures FROM s WHERE caption IS NOT NULL OR n < greatest(5, 0.05 * 200) GROUP BY doc""")
def repeated_figures(spark, sf_dir):
    """Lines of a supplier as figures: the same art in the same place, over and over and without a caption, is furniture."""
    f = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("doc"), F.col("l_orderkey").alias("id"), F.array(((F.col("l_partkey") % 4) * 40).cast("double"), F.lit(1.0)).alias("bbox"), F.col("l_linenumber").cast("string").alias("fingerprint"), F.when(F.col("l_orderkey") % 9 == 0, "c").alias("caption"))
    sizes = f.select("doc").distinct().withColumn("n_pages", F.lit(200))
    return V.without_repeated(f, sizes, ["doc"]).groupBy("doc").agg(F.count("*").alias("n_figures"))


@query(f"""WITH {_RELEASES} SELECT slug, CASE WHEN slug % 3 = 0 THEN version || ' and later' WHEN slug % 3 = 1 THEN version || '+' ELSE version END AS typed, version, slug % 3 <> 2 AS later, later AND slug % 2 = 0 AS stale FROM r""")
def typed_releases(spark, sf_dir):
    """Releases as typed on a command line, with and without a claim to what follows, and the note that a stale index asks for."""
    r = _releases(spark, sf_dir)
    typed = F.when(F.col("slug") % 3 == 0, F.concat("version", F.lit(" and later"))).when(F.col("slug") % 3 == 1, F.concat("version", F.lit("+"))).otherwise(F.col("version"))
    own, note = N.release_of(typed), N.coverage_note(F.lit(5), F.lit(5), F.col("version_later") & (F.col("slug") % 2 == 0))
    return r.select("slug", typed.alias("typed"), own["version"].alias("version"), own["later"].alias("later"), (note != "").alias("stale"))


