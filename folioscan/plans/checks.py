"""Queries: checks of releases, files, labels and furniture, over orders, suppliers and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioscan.operators import outline as O
from folioscan.operators import quality as Q

from .registry import query, table
from .releases import _RELEASES, _TOC, _releases, _toc


@query(f"""WITH {_RELEASES}, d AS (SELECT status AS collection, status || '/' || doc_id AS doc, doc_id, slug, version, k, 'Guide ' || (slug % 40) AS title FROM r), p AS (SELECT status AS collection, doc_id, max(version) AS version FROM r WHERE slug % 3 = 0 GROUP BY ALL UNION ALL SELECT 'O', -1, '2026.1')
SELECT doc, 'edition-unordered' AS code, doc AS example FROM d GROUP BY doc HAVING count(*) > 1 AND count(k) < count(*)
UNION ALL SELECT doc, 'edition-duplicate-version', min(version) FROM d WHERE k IS NOT NULL GROUP BY doc, k HAVING count(*) > 1
UNION ALL SELECT collection, 'edition-ungrouped', lower(title) FROM d GROUP BY collection, title HAVING count(DISTINCT doc_id) > 1
UNION ALL SELECT collection, 'pin-invalid', doc_id || ' ' || version FROM p WHERE doc_id = -1""")
def edition_findings(spark, sf_dir):
    """Releases checked by keys of their own: none, two alike, titles under several ids, pins to nothing."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("slug"), F.col("o_orderstatus").alias("collection"))
    d = _releases(spark, sf_dir).drop("collection").join(o, "slug").withColumn("title", F.concat(F.lit("Guide "), (F.col("slug") % 40).cast("string")))
    pins = d.filter("slug % 3 = 0").groupBy("collection", "doc_id").agg(F.max("version").alias("version")).union(spark.range(1).select(F.lit("O"), F.lit(-1).cast("long"), F.lit("2026.1")))
    return Q.edition_checks(d, pins).select("doc", "code", "example")


@query("""WITH m AS (SELECT o_orderkey AS doc, o_orderstatus AS collection, 'p' || (o_orderkey % 500) || '.pdf' AS pdf, o_custkey % 50 AS n FROM orders), s AS (SELECT collection, pdf, o.doc % 4 = 0 AS root FROM m o), f AS (SELECT DISTINCT o_orderstatus AS collection, 'p' || (o_orderkey % 500) || '.pdf' AS pdf FROM orders WHERE o_orderkey % 3 = 0)
SELECT doc::VARCHAR AS doc, 'full-md-missing' AS code, doc::VARCHAR AS example FROM m WHERE doc % 13 = 0 UNION ALL SELECT doc::VARCHAR, 'source-pdf-missing', m.pdf FROM m LEFT JOIN f USING (collection, pdf) WHERE f.pdf IS NULL
UNION ALL SELECT doc::VARCHAR, 'content-unchecked', pdf FROM m JOIN f USING (collection, pdf) WHERE replace(replace(pdf, 'p', ''), '.df', '')::INT % 10 = 0
UNION ALL SELECT doc::VARCHAR, 'page-count-mismatch', n || ' and ' || (replace(replace(pdf, 'p', ''), '.df', '')::INT % 50) FROM m JOIN f USING (collection, pdf) WHERE replace(replace(pdf, 'p', ''), '.df', '')::INT % 10 <> 0 AND n <> replace(replace(pdf, 'p', ''), '.df', '')::INT % 50
UNION ALL SELECT doc::VARCHAR, 'attribution-declined', doc::VARCHAR FROM m WHERE doc % 17 = 0 UNION ALL SELECT doc::VARCHAR, 'figures-unreadable', doc::VARCHAR FROM m WHERE doc % 19 = 0""")
def document_findings(spark, sf_dir):
    """Orders as documents: which lack full.md, a source PDF that opens with as many pages, readable figures, an attribution."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    number = key % 500
    name = F.concat(F.lit("p"), number.cast("string"), F.lit(".pdf"))
    doc = key.cast("string").alias("doc")
    m = o.select(doc, F.col("o_orderstatus").alias("collection"), name.alias("source_pdf"), (F.col("o_custkey") % 50).alias("page_count"), F.when(key % 17 == 0, "declined").otherwise("attributed").alias("attribution_status"))
    files = o.filter(key % 13 != 0).select(doc, F.lit("full.md").alias("file"))
    pages = F.when(number % 10 != 0, number % 50)
    pdfs = o.filter(key % 3 == 0).select(F.col("o_orderstatus").alias("collection"), F.when(key % 2 == 0, "source").otherwise("root").alias("place"), name.alias("name"), pages.alias("page_count")).distinct()
    return Q.document_checks(m, files, pdfs, o.select(doc, (key % 19 == 0).alias("bad"))).select("doc", "code", "example")


@query("""WITH c AS (SELECT source AS doc, doc_id, text FROM documents), l AS (SELECT doc, doc_id, ' ' || array_to_string(regexp_extract_all(lower(line), '[0-9a-z]+'), ' ') || ' ' AS k FROM (SELECT doc, doc_id, unnest(string_split(text || CASE WHEN doc_id % 50 = 7 THEN chr(10) || '**Feedback**' WHEN doc_id % 9 = 1 THEN chr(10) || 'Manual  of ' || doc ELSE '' END || chr(10) || 'Page label ' || doc_id || ' of part ' || (doc_id % 7), chr(10))) AS line FROM c)),
t AS (SELECT DISTINCT doc, doc_id FROM l WHERE k = ' ' || array_to_string(regexp_extract_all(lower('Manual of ' || doc), '[0-9a-z]+'), ' ') || ' '), d AS (SELECT doc, doc_id FROM l WHERE k = ' feedback ' UNION SELECT doc, doc_id FROM t WHERE doc IN (SELECT doc FROM t GROUP BY doc HAVING count(*) >= 3)
UNION SELECT doc, doc_id FROM c WHERE doc IN (SELECT doc FROM c GROUP BY doc HAVING count(*) >= 10))
SELECT doc, 'furniture' AS code, doc_id::VARCHAR AS example FROM d""")
def furniture_findings(spark, sf_dir):
    """Documents as chunks of their source, with feedback links, running titles and page labels put into them."""
    d = table(spark, sf_dir, "documents")
    key = F.col("doc_id")
    title = F.concat(F.lit("Manual of "), "source")
    extra = F.when(key % 50 == 7, "\n**Feedback**").when(key % 9 == 1, F.concat(F.lit("\nManual  of "), "source")).otherwise("")
    label = F.concat(F.lit("\nPage label "), key.cast("string"), F.lit(" of part "), (key % 7).cast("string"))
    chunks = d.select(F.col("source").alias("doc"), key.alias("ord"), title.alias("title"), F.concat("text", extra, label).alias("body"))
    return Q.furniture_checks(chunks).select("doc", "code", "example")


@query(f"""WITH {_TOC}, c AS (SELECT doc, idx, title, lag(title) OVER (PARTITION BY doc ORDER BY idx) AS prev, level FROM toc)
SELECT doc::VARCHAR AS doc, 'entity-breadcrumb-mismatch' AS code, idx AS pos FROM c WHERE idx % 4 = 0 AND prev IS NOT NULL
UNION ALL SELECT doc::VARCHAR, 'entity-heading-mismatch', idx FROM c WHERE idx % 4 = 0 AND idx % 3 = 0 AND prev IS NOT NULL AND idx % 12 = 0 AND prev IN (SELECT title FROM c x WHERE x.doc = c.doc AND x.idx % 4 = 0)
UNION ALL SELECT doc::VARCHAR, 'ancestor-unverifiable', idx FROM c WHERE doc = 4 AND prev IS NOT NULL
UNION ALL SELECT doc::VARCHAR, 'entity-rarely-named', 0 FROM c GROUP BY doc HAVING count(*) FILTER (WHERE idx % 4 = 0) > 0 AND count(*) FILTER (WHERE idx % 4 = 0 AND idx % 8 = 0) < 0.9 * count(*) FILTER (WHERE idx % 4 = 0)""")
def label_findings(spark, sf_dir):
    """Entries as chunks under the title before theirs, every fourth with an owner that half of them name: breadcrumbs, headings and owners against each other."""
    from pyspark.sql import Window

    toc = _toc(spark, sf_dir).withColumn("doc", F.col("doc").cast("string"))
    prev = F.lag("title").over(Window.partitionBy("doc").orderBy("idx"))
    c = toc.withColumn("prev", prev).filter("prev is not null or idx % 4 = 0")
    own = F.when(F.col("idx") % 4 == 0, F.col("title"))
    chunks = c.select("doc", F.col("idx").cast("long").alias("ord"), F.col("idx").cast("string").alias("file"), F.when(F.col("idx") % 12 == 0, F.col("prev")).otherwise("Other words (intro)").alias("heading"), own.alias("entity"), F.when(F.col("prev").isNotNull(), F.array("prev")).alias("ancestors"), F.concat(F.lit("about "), F.when(F.col("idx") % 8 == 0, F.col("title")).otherwise("nothing")).alias("body"), F.lit(None).cast("long").alias("page_start"), F.lit(None).cast("long").alias("page_end"))
    spans = O.ranked_spans(toc, ["doc"]).withColumn("title_key", Q.words_of("title")).withColumn("end_page", F.lit(None).cast("long"))
    found = Q.label_checks(chunks, toc.filter("doc <> '4'"), spans.filter("doc <> '4'"))
    return found.filter("code <> 'ancestor-not-nested'").select("doc", "code", "pos")
