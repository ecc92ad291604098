"""Queries: releases, catalogs, page ranges, outlines, entries, call logs, over the star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioscan.functions import text as X
from folioscan.operators import calls as K
from folioscan.operators import catalog_tables as G
from folioscan.operators import editions as D
from folioscan.operators import lookup as L
from folioscan.operators import structure as T
from folioscan.streaming import calls as SC

from .registry import query, table

# Orders as releases of a customer's manual, their versions written in all the ways there are: without a number, without a year of this century, with underscores, letters and service packs.
_VERSION = """CASE o_orderkey % 7 WHEN 0 THEN 'beta' || chr(97 + (o_orderkey % 3)::INT) WHEN 1 THEN (year(o_orderdate) - 200) || '.' || month(o_orderdate) || '.1' WHEN 2 THEN 'v' || y || '_' || month(o_orderdate)
WHEN 3 THEN 'Y-' || y || '.' || lpad(month(o_orderdate)::VARCHAR, 2, '0') || '-SP' || (o_orderkey % 3) || '-2' WHEN 4 THEN y || '.' || month(o_orderdate) || '.' || (o_orderkey % 4)
ELSE y || '.' || month(o_orderdate) || CASE WHEN o_orderkey % 5 = 0 THEN '-SP' || (o_orderkey % 3) ELSE '' END END"""
_KEY = """CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN [year(o_orderdate) - 200, month(o_orderdate), 1] WHEN 2 THEN [y, month(o_orderdate), -1, 0, 0] WHEN 3 THEN [y, month(o_orderdate), -1, o_orderkey % 3, 2]
WHEN 4 THEN [y, month(o_orderdate), o_orderkey % 4, -1, 0, 0] ELSE [y, month(o_orderdate), -1, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 3 ELSE 0 END, 0] END"""
_RELEASES = f"r AS (SELECT o_custkey AS doc_id, o_orderkey AS slug, o_orderstatus AS status, {_VERSION} AS version, ({_KEY})::BIGINT[] AS k, o_orderpriority LIKE '1%' AS later FROM (SELECT *, year(o_orderdate) + 10 AS y FROM orders))"


def _releases(spark, sf_dir):
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    y, m = (F.year("o_orderdate") + 10).cast("string"), F.month("o_orderdate").cast("string")
    left = lambda n: (key % n).cast("string")
    version = (
        F.when(key % 7 == 0, F.concat(F.lit("beta"), F.chr(97 + key % 3)))
        .when(key % 7 == 1, F.concat((F.year("o_orderdate") - 200).cast("string"), F.lit("."), m, F.lit(".1")))
        .when(key % 7 == 2, F.concat(F.lit("v"), y, F.lit("_"), m))
        .when(key % 7 == 3, F.concat(F.lit("Y-"), y, F.lit("."), F.lpad(m, 2, "0"), F.lit("-SP"), left(3), F.lit("-2")))
        .when(key % 7 == 4, F.concat(y, F.lit("."), m, F.lit("."), left(4)))
        .otherwise(F.concat(y, F.lit("."), m, F.when(key % 5 == 0, F.concat(F.lit("-SP"), left(3))).otherwise("")))
    )
    return o.select(F.lit("orders").alias("collection"), F.col("o_custkey").alias("doc_id"), key.alias("slug"), version.alias("version"), F.col("o_orderpriority").startswith("1").alias("version_later"))


@query(f"""WITH {_RELEASES} SELECT slug, version, array_to_string(k, '.') AS version_key, array_to_string(list_transform(k, lambda n: CASE WHEN n < 0 THEN '-00001' ELSE lpad(n::VARCHAR, 6, '0') END), '.') AS version_text FROM r""")
def version_sort_key(spark, sf_dir):
    """The numbers that order each release, and the text that sorts as they do."""
    return _releases(spark, sf_dir).select("slug", "version", F.array_join(X.version_key("version").cast("array<string>"), ".").alias("version_key"), X.version_text("version").alias("version_text"))


@query(f"""WITH {_RELEASES}, t AS (SELECT *, max(k) OVER (PARTITION BY doc_id) AS top, count(*) OVER (PARTITION BY doc_id) AS n, count(k) OVER (PARTITION BY doc_id) AS known FROM r), u AS (SELECT *, count(*) FILTER (WHERE k = top) OVER (PARTITION BY doc_id) AS tied FROM t)
SELECT doc_id, slug, CASE WHEN n = 1 THEN true WHEN known = n AND tied = 1 THEN k = top END AS is_current FROM u""")
def edition_current(spark, sf_dir):
    """Which release of each customer is current; undecided where two tie or one has no number."""
    return D.resolved(_releases(spark, sf_dir)).select("doc_id", "slug", "is_current")


@query(f"""WITH {_RELEASES}, q AS (SELECT DISTINCT doc_id, want, name, wk FROM r, (VALUES ('2006.6', '2006.6', [2006, 6, -1, 0, 0]::BIGINT[]), ('Beta A', 'BETAA', NULL), ('v2004_03-SP1', '2004.03-SP1', [2004, 3, -1, 1, 0]::BIGINT[])) AS v(want, name, wk)
  UNION SELECT doc_id, lower(version), upper(CASE WHEN version LIKE 'v%' THEN replace(version[2:], '_', '.') ELSE version END), k FROM r),
m AS (SELECT q.*, r.k, r.slug, r.later, upper(CASE WHEN r.version LIKE 'v%' THEN replace(r.version[2:], '_', '.') ELSE r.version END) = q.name OR coalesce(r.k = q.wk, false) AS same FROM q JOIN r USING (doc_id)),
e AS (SELECT doc_id, want, arg_min(slug, struct_pack(u := k IS NOT NULL, k := k, s := slug)) FILTER (WHERE same) AS exact, max(struct_pack(k := k, slug := slug, later := later)) FILTER (WHERE k < wk) AS b FROM m GROUP BY doc_id, want)
SELECT doc_id, want AS version, CASE WHEN exact IS NOT NULL THEN exact WHEN b.later THEN b.slug END AS slug, CASE WHEN exact IS NOT NULL THEN 'exact' WHEN b.later THEN 'earlier, and later' WHEN b IS NOT NULL THEN 'not covered' ELSE 'no edition' END AS how FROM e""")
def edition_asof(spark, sf_dir):
    """The release of each customer that answers for three versions, one of them without a number, and for each of its own."""
    docs = _releases(spark, sf_dir)
    some = docs.select("collection", "doc_id", F.explode(F.array(F.lit("2006.6"), F.lit("Beta A"), F.lit("v2004_03-SP1"))).alias("version"))
    asked = some.union(docs.select("collection", "doc_id", F.lower("version"))).distinct().withColumn("request", F.struct("doc_id", "version"))
    return D.as_of(asked, docs).select("doc_id", "version", "slug", "how")


@query(f"""WITH {_RELEASES} SELECT doc_id, 'edition-duplicate-version' AS problem, min(version) AS version FROM r WHERE k IS NOT NULL GROUP BY doc_id, k HAVING count(*) > 1
UNION ALL SELECT doc_id, 'edition-unordered', NULL FROM r GROUP BY doc_id HAVING count(*) > 1 AND count(k) < count(*)""")
def edition_problems(spark, sf_dir):
    """Customers with two releases of the same order, or several of which one has no number."""
    return D.problems(_releases(spark, sf_dir)).select("doc_id", "problem", "version")


@query("""WITH f AS (SELECT DISTINCT p_name || CASE WHEN p_size % 2 = 0 THEN '!' ELSE '' END AS folder FROM part), k AS (SELECT folder, trim(regexp_replace(lower(folder), '[^a-z0-9]+', '-', 'g'), '-') AS collection FROM f)
SELECT collection, count(*) AS n_folders, string_agg(folder, '|' ORDER BY folder) AS folders FROM k GROUP BY collection HAVING count(*) > 1""")
def collection_clash(spark, sf_dir):
    """Names of parts as folders: keys that two of them share."""
    return D.clashes(table(spark, sf_dir, "part").select(F.concat("p_name", F.when(F.col("p_size") % 2 == 0, "!").otherwise("")).alias("folder")))


@query("""WITH s AS (SELECT lang AS collection, source AS slug, count(*) AS section_count, count(*) FILTER (WHERE l.doc_id IS NOT NULL) AS indexed_count, coalesce(sum(CASE WHEN l.doc_id IS NOT NULL THEN length(text) END), 0)::BIGINT AS char_count, bool_or(d.doc_id % 3 = 0) AS has_pages, bool_or(d.doc_id % 10 = 0) AS has_entities FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY ALL) SELECT * FROM s""")
def catalog_stats(spark, sf_dir):
    """Sources as documents, their documents as sections, of which the labelled ones are indexed."""
    c = _sections(spark, sf_dir)
    return G.document_stats(c.select("collection", "slug").distinct(), c).drop("figure_count")


def _sections(spark, sf_dir):
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("_l", F.lit(1))
    d = table(spark, sf_dir, "documents").join(labelled, "doc_id", "left")
    return d.select(F.col("lang").alias("collection"), F.col("source").alias("slug"), F.when(F.col("_l").isNotNull(), F.col("text")).alias("body"), F.when(F.col("doc_id") % 3 == 0, F.col("doc_id")).alias("page_start"), F.when(F.col("doc_id") % 10 == 0, F.col("source")).alias("entity"))


@query("""WITH s AS (SELECT lang AS collection, source AS slug, count(*) AS n, count(l.doc_id) AS i FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY ALL)
SELECT collection, slug, n - i AS gap, (SELECT sum(n) FROM s)::BIGINT AS all_sections, (SELECT sum(i) FROM s)::BIGINT AS all_indexed FROM s WHERE n > i ORDER BY gap DESC, collection, slug LIMIT 4""")
def coverage_gap(spark, sf_dir):
    """The four sources with most documents that aren't labelled."""
    c = _sections(spark, sf_dir)
    return G.coverage_gap(G.document_stats(c.select("collection", "slug").distinct(), c))


@query("""SELECT l_suppkey AS slug, p_name || ' ' || p_partkey AS name, lower(p_name || ' ' || p_partkey) AS name_lower, count(*) AS chunk_count, min(l_orderkey) AS page_start, max(l_orderkey + l_linenumber) AS page_end FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL""")
def entity_rollup(spark, sf_dir):
    """Parts as entries of a supplier's reference, order keys as pages."""
    return L.entities(_entries(spark, sf_dir), ["slug"])


def _entries(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("entity"))
    return table(spark, sf_dir, "lineitem").join(part, "l_partkey").select(F.col("l_suppkey").alias("slug"), "entity", F.col("l_orderkey").alias("page_start"), (F.col("l_orderkey") + F.col("l_linenumber")).alias("page_end"))


@query("""WITH e AS (SELECT l_suppkey AS slug, p_name || ' ' || p_partkey AS entity, count(*) AS chunk_count, min(l_orderkey) AS page_start, max(l_orderkey + l_linenumber) AS page_end FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),
q AS (SELECT p_partkey AS qid, upper(p_name) || '  ' || p_partkey AS name FROM part) SELECT qid, q.name, slug, entity, chunk_count, page_start, page_end FROM q LEFT JOIN e ON lower(e.entity) = trim(regexp_replace(lower(q.name), '\\s+', ' ', 'g'), ' ')""")
def entity_lookup(spark, sf_dir):
    """All parts, asked for in capitals and with blanks."""
    asked = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("qid"), F.concat(F.upper("p_name"), F.lit("  "), F.col("p_partkey").cast("string")).alias("name"))
    return L.lookup(asked, L.entities(_entries(spark, sf_dir), ["slug"]), ["slug"])


_RANGES = "s AS (SELECT o_custkey AS doc, o_orderkey AS sec, o_orderkey AS ps, o_orderkey + 1 + o_orderkey % 40 AS pe FROM orders), f AS (SELECT o_custkey AS doc, o_orderkey AS fig, o_orderkey + 5 AS page FROM orders)"


def _ranges(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(F.col("o_custkey").alias("doc"), k.alias("sec"), k.alias("ps"), (k + 1 + k % 40).alias("pe")), o.select(F.col("o_custkey").alias("doc"), k.alias("fig"), (k + 5).alias("page"))


@query(f"WITH {_RANGES} SELECT fig, min(sec) AS sec FROM f JOIN s ON s.doc = f.doc AND page BETWEEN ps AND pe GROUP BY fig HAVING count(*) = 1")
def page_containment(spark, sf_dir):
    """Figures on a page that exactly one section covers."""
    sections, figures = _ranges(spark, sf_dir)
    return T.only_range(figures, sections, ["doc"], "fig", "page", "ps", "pe", "sec")


@query("""WITH s AS (SELECT l_partkey AS k, l_orderkey AS page, CASE WHEN l_linenumber % 4 = 0 AND l_orderkey % 64 = 0 THEN NULL ELSE l_orderkey + l_linenumber END AS e FROM lineitem), c AS (SELECT l_partkey AS k, l_orderkey * 10 + l_linenumber AS ord, l_orderkey + 100 AS ps, CASE WHEN l_linenumber < 7 THEN l_orderkey + 200 END AS pe FROM lineitem)
SELECT c.k, c.ord, bool_or(CASE WHEN s.page IS NOT NULL AND pe IS NOT NULL THEN s.page <= pe AND (s.e IS NULL OR s.e >= ps) END) AS verdict FROM c LEFT JOIN s ON s.k = c.k GROUP BY c.k, c.ord""")
def interval_overlap(spark, sf_dir):
    """Lines of a part as outline spans and as chunks: whether a span of the same key overlaps."""
    li = table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    spans = li.select(F.col("l_partkey").alias("k"), F.col("l_orderkey").alias("page"), F.when((n % 4 != 0) | (F.col("l_orderkey") % 64 != 0), F.col("l_orderkey") + n).alias("end_page"))
    chunks = li.select(F.col("l_partkey").alias("k"), (F.col("l_orderkey") * 10 + n).alias("ord"), (F.col("l_orderkey") + 100).alias("page_start"), F.when(n < 7, F.col("l_orderkey") + 200).alias("page_end"))
    return T.overlapping(spans, chunks.distinct(), ["k"])


_TOC = """toc AS (SELECT r_regionkey AS doc, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey, lv, s_suppkey) AS idx, lv AS level, title, CASE lv WHEN 1 THEN n_nationkey * 1000 ELSE n_nationkey * 1000 + s_suppkey END AS page FROM (
SELECT r_regionkey, n_nationkey, 1 AS lv, -1 AS s_suppkey, n_name AS title FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT r_regionkey, n_nationkey, 2 + s_suppkey % 2, s_suppkey, s_name FROM nation JOIN region ON r_regionkey = n_regionkey JOIN supplier ON s_nationkey = n_nationkey))"""


def _toc(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    top = nation.select(F.col("r_regionkey").alias("doc"), "n_nationkey", F.lit(1).cast("long").alias("level"), F.lit(-1).cast("long").alias("s"), F.col("n_name").alias("title"))
    below = nation.join(table(spark, sf_dir, "supplier"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("r_regionkey").alias("doc"), "n_nationkey", (2 + F.col("s_suppkey") % 2).alias("level"), F.col("s_suppkey").alias("s"), F.col("s_name").alias("title"))
    rows = top.unionByName(below).withColumn("idx", F.row_number().over(Window.partitionBy("doc").orderBy("n_nationkey", "level", "s")))
    return rows.select("doc", "idx", "level", "title", (F.col("n_nationkey").cast("long") * 1000 + F.greatest("s", F.lit(0))).alias("page"))


@query(f"""WITH {_TOC} SELECT a.doc, a.idx, a.level, a.page, (SELECT b.page FROM toc b WHERE b.doc = a.doc AND b.level <= a.level AND (b.page > a.page OR (b.page = a.page AND b.idx > a.idx)) ORDER BY b.page, b.idx LIMIT 1) AS end_page FROM toc a""")
def toc_spans(spark, sf_dir):
    """Regions as manuals, nations and suppliers as entries: where each ends."""
    return T.toc_spans(_toc(spark, sf_dir), ["doc"]).select("doc", "idx", "level", "page", "end_page")


@query(f"""WITH {_TOC}, u AS (SELECT a.doc, a.idx, b.idx AS i, b.level, b.title FROM toc a JOIN toc b ON b.doc = a.doc AND b.idx <= a.idx AND b.level <= a.level AND (b.level < a.level OR b.idx = a.idx) AND NOT EXISTS (SELECT 1 FROM toc c WHERE c.doc = a.doc AND c.idx > b.idx AND c.idx <= a.idx AND c.level <= b.level))
SELECT doc, idx, string_agg(title, ' > ' ORDER BY level, i) AS chain FROM u GROUP BY doc, idx""")
def toc_chains(spark, sf_dir):
    """The titles above each entry."""
    return T.toc_chains(_toc(spark, sf_dir), ["doc"]).select("doc", "idx", F.array_join("chain", " > ").alias("chain"))


_LOG = "lg AS (SELECT user_id, event_id AS pos, CASE event_type WHEN 'error' THEN 'Error: ' WHEN 'click' THEN 'Warning: ' ELSE '' END || 'step (MSG-' || lpad((event_id % 97)::VARCHAR, 3, '0') || ') Rule C' || (event_id % 9) || ' seen' AS line FROM events)"


def _log(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    head = F.when(F.col("event_type") == "error", "Error: ").when(F.col("event_type") == "click", "Warning: ").otherwise("")
    line = F.concat(head, F.lit("step (MSG-"), F.lpad((F.col("event_id") % 97).cast("string"), 3, "0"), F.lit(") Rule C"), (F.col("event_id") % 9).cast("string"), F.lit(" seen"))
    return e.select("user_id", F.col("event_id").alias("pos"), line.alias("line"))


@query(f"""WITH {_LOG}, i AS (SELECT user_id, pos, line, 'code' AS kind, regexp_extract(line, '([A-Z][A-Z0-9]{{1,9}}-\\d{{2,5}})', 1) AS code FROM lg UNION ALL SELECT user_id, pos, line, 'rule', regexp_extract(line, 'Rule ([A-Z]{{1,3}}\\d{{1,4}})', 1) FROM lg)
SELECT user_id, kind, code, count(*) AS n_lines, min(pos) AS first_pos, arg_min(line, pos) AS sample, min(CASE WHEN line LIKE 'Error%' THEN 1 WHEN line LIKE 'Warning%' THEN 2 ELSE 4 END) AS severity FROM i GROUP BY ALL""")
def log_scan(spark, sf_dir):
    """Events as log lines: codes and rules by user."""
    return L.scan_log(_log(spark, sf_dir), ["user_id"])


@query(f"""WITH {_LOG}, i AS (SELECT user_id, pos, line, 'code' AS kind, regexp_extract(line, '([A-Z][A-Z0-9]{{1,9}}-\\d{{2,5}})', 1) AS code FROM lg UNION ALL SELECT user_id, pos, line, 'rule', regexp_extract(line, 'Rule ([A-Z]{{1,3}}\\d{{1,4}})', 1) FROM lg),
s AS (SELECT user_id, kind, code, count(*) AS n_lines, min(pos) AS first_pos, min(CASE WHEN line LIKE 'Error%' THEN 1 WHEN line LIKE 'Warning%' THEN 2 ELSE 4 END) AS severity FROM i GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY severity, n_lines DESC, first_pos, code) AS n FROM s)
SELECT user_id, n, code, r.code NOT IN (SELECT 'C' || k FROM (SELECT unnest([1, 2, 3]) AS k)) AS missing FROM r WHERE n <= 25""")
def log_explained(spark, sf_dir):
    """The first 25 items of each log, with entries for three rules only."""
    entries = spark.createDataFrame([(f"drc rule c{k}", f"About rule C{k}") for k in (1, 2, 3)], "name_lower string, text string")
    return L.explained(L.scan_log(_log(spark, sf_dir), ["user_id"]), entries, ["user_id"]).select("user_id", "n", "code", "missing")


@query("""WITH r AS (SELECT event_type AS tool, value AS ms, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT tool, count(*) AS calls, count(*) FILTER (WHERE ms > 100) AS errors, round(median(ms), 6) AS median_ms, max(ms) FILTER (WHERE k = floor(0.95 * (n - 1))) AS p95_ms, round(avg(ms), 6) AS mean_ms FROM r GROUP BY tool""")
def call_summary(spark, sf_dir):
    """Events as calls of tools: counts, median, 95th percentile, mean."""
    return K.summary(table(spark, sf_dir, "events").select(F.col("event_type").alias("tool"), F.col("value").alias("ms"), (F.col("value") > 100).alias("error")))


@query(r"""WITH c AS (SELECT conv_id * 100 + turn AS p, text, lower(trim(regexp_replace(text, '[ \t\n\v\f\r]+', ' ', 'g'), ' ')) AS key FROM conversations WHERE role = 'user')
SELECT key, count(*) AS n, arg_max(text, p) AS last, min(p) AS first_at FROM c GROUP BY key""")
def search_groups(spark, sf_dir):
    """User turns as searches, alike but for case and blanks."""
    rows = table(spark, sf_dir, "conversations").filter("role = 'user'").select(F.col("text").alias("q"), (F.col("conv_id") * 100 + F.col("turn")).alias("at"))
    return K.groups(rows, "q", [], "at")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type AS tool, count(*) AS calls, count(*) FILTER (WHERE value > 100) AS errors, round(avg(value), 6) AS mean_ms FROM events GROUP BY ALL")
def calls_by_hour(spark, sf_dir):
    """Tumbling hours of events by type: the table twin of the streaming query."""
    return SC.by_hour(table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("tool"), F.col("value").alias("ms"), (F.col("value") > 100).alias("error")))


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id AS token_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS stop, count(*) AS calls FROM s GROUP BY user_id, sid""")
def call_sessions(spark, sf_dir):
    """Sessions of users with gaps of half an hour."""
    return SC.sessions(table(spark, sf_dir, "events").select("ts", F.col("user_id").alias("token_id")))


@query("""WITH d AS (SELECT collection, doc_id, count(*) AS n FROM (SELECT o_orderstatus AS collection, o_custkey AS doc_id FROM orders) GROUP BY ALL) SELECT o_orderstatus AS collection, o_custkey AS doc_id, o_orderkey AS slug, n AS n_editions FROM orders JOIN d ON collection = o_orderstatus AND doc_id = o_custkey""")
def catalog_list(spark, sf_dir):
    """Orders as documents with the number of editions beside each."""
    return G.listing(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("collection"), F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("slug")))
