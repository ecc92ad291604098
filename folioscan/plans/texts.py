"""Queries: lines, furniture, headings, identifiers, structure, differences and checks, over documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from folioscan.functions import text as X
from folioscan.operators import compare as C
from folioscan.operators import editions as D
from folioscan.operators import furniture as U
from folioscan.operators import quality as Q
from folioscan.operators import sampling as P
from folioscan.operators import structure as T
from folioscan.operators.lookup import budgeted, reassembled

from .registry import query, table

_SP = r"[ \t\n\v\f\r]+"


def _bare(x: str) -> str:
    """SQL of a text without one pair of marks around it, where something is left."""
    cases = " ".join(f"WHEN regexp_matches({x}, '^{m}.+{m}$') THEN {x}[{n + 1}:-{n + 1}]" for m, n in ((r"\*\*\*", 3), (r"\*\*", 2), (r"\*", 1), ("___", 3), ("__", 2), ("_", 1), ("`", 1)))
    return f"coalesce(nullif(trim(CASE {cases} ELSE {x} END, ' '), ''), {x})"


def _stripped(rows: str, x: str, out: str, name: str) -> str:
    """CTEs that add to `rows` the column `out`: x without heading marks and up to three pairs of marks; the last of them has the name."""
    steps = [f"{name}_0 AS (SELECT *, trim(regexp_replace(trim({x}, ' '), '^#{{1,6}}\\s+', ''), ' ') AS {out}_0 FROM {rows})"]
    steps += [f"{name}_{k} AS (SELECT *, {_bare(f'{out}_{k - 1}')} AS {out}_{k} FROM {name}_{k - 1})" for k in (1, 2, 3)]
    return ",\n".join([*steps, f"{name} AS (SELECT * EXCLUDE ({out}_0, {out}_1, {out}_2, {out}_3), {out}_3 AS {out} FROM {name}_3)"])


#: Lines of documents with their core and whether they are code, and those shaped like headers.
_LINES = rf"""
l0 AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos FROM documents),
l1 AS (SELECT *, regexp_matches(line, '^\s*```') OR sum(CASE WHEN regexp_matches(line, '^\s*```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) % 2 = 1 AS in_code FROM l0),
{_stripped('l1', 'line', 'core', 'l')},
c AS (SELECT DISTINCT source, doc_id, core FROM l WHERE NOT in_code AND (lower(core) = 'feedback' OR (NOT regexp_matches(trim(line, ' '), '^$|^[|>*+•#-]|^```') AND regexp_matches(core, '[A-Za-z]') AND length(core) <= 120 AND regexp_matches(core, '\s') AND NOT regexp_matches(core, '^[\w\s.-]*[_(){{}};=]+[\w\s.-]*$') AND NOT regexp_matches(core, '^<!--|-->$')))),
n AS (SELECT source, core, count(*) AS n FROM c GROUP BY source, core)
"""
#: Comparable forms of these lines, the line most texts of a source share as its title, and the furniture that follows from it.
_FURNITURE = rf"""
{_stripped('n', 'core', 'k1', 'n1')},
n2 AS (SELECT *, translate(regexp_replace(k1, '</?[A-Za-z][^>]*>', '', 'g'), '™℠®©', '') AS k2 FROM n1),
{_stripped('n2', 'k2', 'k3', 'n3')},
k AS (SELECT *, lower(trim(regexp_replace(regexp_replace(k3, '\s*[’'']\s*', '', 'g'), '{_SP}', ' ', 'g'), ' ')) AS norm, translate(trim(regexp_replace(regexp_replace(core, '</?[A-Za-z][^>]*>', '', 'g'), '{_SP}', ' ', 'g'), ' '), '™℠®©', '') AS spaced FROM n3),
t AS (SELECT source, norm AS t FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, core) AS r FROM k) WHERE r = 1),
f AS (SELECT k.source, core, n FROM k JOIN t USING (source) WHERE norm = 'feedback' OR (t <> '' AND norm <> '' AND n >= 3 AND (
  (starts_with(norm, left(t, 40)) AND NOT regexp_matches(norm[length(left(t, 40)) + 1:length(left(t, 40)) + 1], '[\p{{L}}\p{{N}}]') AND NOT regexp_matches(spaced[length(left(t, 40)) + 1:], '\b[a-z]+\s+[a-z]+\s+[a-z]+\b'))
  OR (starts_with(t, left(norm, 40)) AND length(norm) >= 0.6 * length(t)))))
"""


def _lines(spark, sf_dir):
    return U.exploded(table(spark, sf_dir, "documents").select("source", "doc_id", "text"), ["source"], "doc_id")


def _titles(lines):
    """The line that most texts of a source share, as its title."""
    counts = U.candidates(lines, ["source"], "doc_id").groupBy("source", "core").agg(F.count("*").alias("n"))
    return counts.groupBy("source").agg(F.min(F.struct((-F.col("n")).alias("n"), "core")).alias("b")).select("source", F.col("b.core").alias("title"))


@query(f"WITH {_LINES}, {_FURNITURE} SELECT source, core FROM f")
def line_furniture(spark, sf_dir):
    """Sources as manuals, documents as their sections, the line that most of these share as the title: what counts as running title."""
    lines = _lines(spark, sf_dir)
    return U.detected(lines, _titles(lines), ["source"], "doc_id")


@query("""WITH s AS (SELECT o_orderpriority AS doc, CASE WHEN o_orderkey % 10 = 0 THEN 'B-' || (o_orderkey % 300) ELSE (o_orderkey % 300) || '-' || (o_custkey % 50) END || ' Ledger Version 2026.2' AS label FROM orders)
SELECT doc, '#-# Ledger Version #.#' AS masked, count(*) AS n_texts, count(DISTINCT label) AS n_distinct FROM s GROUP BY doc HAVING count(*) >= 10 AND count(DISTINCT label) >= 30 AND count(DISTINCT label) >= 0.5 * count(*)""")
def masked_line_labels(spark, sf_dir):
    """Orders as pages with a page label, a numbered line of prose, an option and a name with a number: only the label is one, where it varies enough."""
    o = table(spark, sf_dir, "orders")
    number = lambda c, n: (F.col(c) % n).cast("string")
    page = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("B-"), number("o_orderkey", 300))).otherwise(F.concat(number("o_orderkey", 300), F.lit("-"), number("o_custkey", 50)))
    text = F.concat_ws("\n", F.concat(page, F.lit(" Ledger Version 2026.2")), F.concat(F.lit("Fix the clock case "), number("o_orderkey", 7), F.lit(".")), F.concat(F.lit("use run_step -n "), number("o_orderkey", 300)), F.concat(F.lit("see the cell ab"), number("o_orderkey", 300)))
    lines = U.exploded(o.select(F.col("o_orderpriority").alias("doc"), "o_orderkey", text.alias("text")), ["doc"], "o_orderkey")
    return U.page_labels(U.candidates(lines, ["doc"], "o_orderkey"), o.groupBy(F.col("o_orderpriority").alias("doc")).agg(F.count("*").alias("n_all")), ["doc"], "o_orderkey")


@query(f"""WITH {_LINES}, {_FURNITURE},
m AS (SELECT l.*, NOT in_code AND f.core IS NOT NULL AS hit FROM l LEFT JOIN f ON f.source = l.source AND f.core = l.core),
w AS (SELECT *, max(hit) OVER (PARTITION BY source, doc_id ORDER BY pos ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near FROM m)
SELECT doc_id, count(*) AS n_lines, sum(length(line))::BIGINT AS n_chars FROM w WHERE NOT hit AND NOT (near AND NOT in_code AND (regexp_matches(line, '^\\s*[0-9]{{1,4}}\\s*$') OR regexp_matches(line, '^\\s*(?i:Chapter|Appendix|Section)\\s+\\w{{1,4}}\\s*:'))) GROUP BY doc_id""")
def strip_adjacent_lines(spark, sf_dir):
    """What stays of each document without furniture and what stands beside it."""
    lines = _lines(spark, sf_dir)
    kept = U.stripped(lines, U.detected(lines, _titles(lines), ["source"], "doc_id"), ["source"], "doc_id")
    return kept.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


@query(r"""WITH t AS (SELECT page_id, unnest(regexp_split_to_array(html, '[ \t\n\v\f\r]+')) AS raw FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(raw, '^[`''"()\[\]{}<>,;:?!]+', ''), '[`''"()\[\]{}<>,;:?!]+$', ''), '\.+$', '') AS t FROM t)
SELECT lower(t) AS ident, count(*) AS n, count(DISTINCT page_id) AS n_pages FROM b WHERE t <> '' AND (contains(t, '_') OR (t LIKE '-%' AND length(t) > 1) OR regexp_full_match(t, '[A-Z][A-Z0-9]{1,9}-\d{2,5}')) GROUP BY ALL""")
def ident_tokens(spark, sf_dir):
    """Identifier-shaped tokens of raw pages."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(X.identifiers("html")).alias("ident"))
    per = rows.groupBy("ident", "page_id").agg(F.count("*").alias("k"))
    return per.groupBy("ident").agg(F.sum("k").alias("n"), F.count("*").alias("n_pages"))


@query(rf"""SELECT doc_id, CASE WHEN s = '' THEN 'section' ELSE s END || CASE WHEN n > 1 THEN '-' || n ELSE '' END AS slug, noise FROM (
SELECT *, row_number() OVER (PARTITION BY source, CASE WHEN s = '' THEN 'section' ELSE s END ORDER BY doc_id) AS n FROM (
SELECT *, regexp_replace(left(regexp_replace(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 40), '-+$', '') AS s,
regexp_matches(lower(trim(regexp_replace(split_part(text, chr(10), 1), '{_SP}', ' ', 'g'), ' ')), '^(?:contents|table of contents|index|feedback|list of (?:figures|tables))(?: \((?:cont\.|intro)\))*$')
OR lower(trim(regexp_replace(split_part(text, chr(10), 1), '{_SP}', ' ', 'g'), ' ')) LIKE 'about this%'
OR (len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '')) >= 4 AND 10 * len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> '' AND regexp_matches(x, '\.\s?\.\s?\.\s?\.'))) >= 3 * len(list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ') <> ''))) AS noise FROM documents))""")
def slug_dedupe(spark, sf_dir):
    """Slugs of first lines, made unique within a source, and the front-matter flag."""
    first = F.substring_index("text", "\n", 1)
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", X.slug(first, 40, "section").alias("slug"), X.is_noise(first, "text").alias("noise"))
    return T.dedupe_slugs(rows, ["source"], "slug", "doc_id").select("doc_id", "slug", "noise")


@query(r"""WITH x AS (SELECT size, sha256, count(*) AS n, min(doc_id) AS first_name FROM (SELECT doc_id, octet_length(encode(text)) AS size, sha256(text) AS sha256 FROM documents) GROUP BY ALL HAVING count(*) > 1) SELECT sha256, size, n, first_name FROM x""")
def byte_twins(spark, sf_dir):
    """Documents of the same size and bytes."""
    return D.byte_twins(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), F.encode("text", "UTF-8").alias("content")))


@query("""WITH n AS (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos FROM documents),
a AS (SELECT source, line, pos, doc_id, row_number() OVER (PARTITION BY source, line ORDER BY doc_id, pos) AS k FROM n WHERE doc_id % 2 = 0),
b AS (SELECT source, line, count(*) AS m FROM n WHERE doc_id % 2 = 1 GROUP BY ALL)
SELECT doc_id, count(*) AS n_lines, min(pos) AS first_pos FROM a LEFT JOIN b USING (source, line) WHERE k > coalesce(m, 0) GROUP BY doc_id""")
def multiset_diff(spark, sf_dir):
    """Lines of the even documents of a source that its odd ones don't have as often."""
    lines = table(spark, sf_dir, "documents").select("source", "doc_id", F.posexplode(X.lines("text")).alias("pos", "line"))
    mine = lines.filter("doc_id % 2 = 0").withColumn("at", F.struct("doc_id", "pos"))
    left = C.only_in(mine, lines.filter("doc_id % 2 = 1"), ["source"], "line", "at")
    return left.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.min("pos").alias("first_pos"))


@query("""WITH n AS (SELECT lang, doc_id % 2 AS side, lower(split_part(text, ' ', 1)) AS k FROM documents), c AS (SELECT lang, k, count(*) FILTER (WHERE side = 0) AS o, count(*) FILTER (WHERE side = 1) AS w FROM n GROUP BY ALL)
SELECT lang, sum(greatest(w - o, 0))::BIGINT AS added, sum(greatest(o - w, 0))::BIGINT AS removed, sum(least(o, w))::BIGINT AS common FROM c GROUP BY lang""")
def set_diff_listing(spark, sf_dir):
    """First words of even and odd documents of a language as two listings."""
    rows = table(spark, sf_dir, "documents").select("lang", "doc_id", F.lower(F.substring_index("text", " ", 1)).alias("k"))
    return C.listing(rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 = 1"), ["lang"], "k")


@query("""WITH f AS (SELECT conv_id, turn, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS n, role = 'user' AS fence FROM conversations)
SELECT conv_id, count(*) FILTER (WHERE fence OR n % 2 = 1) AS n_code, count(*) AS n_lines FROM f GROUP BY conv_id""")
def fence_state(spark, sf_dir):
    """User turns as fences: which turns stand between them."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", "```").otherwise("-").alias("line"))
    return T.fence_state(rows, ["conv_id"], "turn").groupBy("conv_id").agg(F.count_if("in_code").alias("n_code"), F.count("*").alias("n_lines"))


@query("""SELECT w.conv_id, w.turn AS at, r.turn, r.role, length(r.text) AS n_chars FROM conversations w JOIN conversations r ON r.conv_id = w.conv_id AND r.turn BETWEEN w.turn - 1 AND w.turn + 1 WHERE w.role = 'assistant'""")
def neighbour_context(spark, sf_dir):
    """Assistant turns with the turns beside them."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("n_chars"))
    return T.neighbours(rows, rows.filter("role = 'assistant'").select("conv_id", "turn"), ["conv_id"], "turn", 1)


@query(r"""SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1), '[ \t\n\v\f\r]+', ' ', 'g'), ' ') AS title, trim(regexp_replace(regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1), '[ \t\n\v\f\r]+', ' ', 'g'), ' ') AS h1, len(regexp_extract_all(html, '<h[1-6][ >]')) AS n_headings, len(regexp_extract_all(html, '<p[ >]')) AS n_paragraphs FROM pages""")
def html_outline(spark, sf_dir):
    """Titles and headings of raw pages."""
    pick = lambda tag: X.collapse(F.regexp_extract("html", f"<{tag}[^>]*>([^<]*)</{tag}>", 1))
    return table(spark, sf_dir, "pages").select("page_id", pick("title").alias("title"), pick("h1").alias("h1"), F.size(F.regexp_extract_all("html", F.lit("<h[1-6][ >]"), F.lit(0))).alias("n_headings"), F.size(F.regexp_extract_all("html", F.lit("<p[ >]"), F.lit(0))).alias("n_paragraphs"))


@query("""WITH w AS (SELECT conv_id, turn, text, sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM conversations), n AS (SELECT conv_id, sum(length(text) + 1) - 1 AS n_chars FROM conversations GROUP BY conv_id)
SELECT conv_id, md5(left(string_agg(text, chr(10) ORDER BY turn), 1000)) AS digest, any_value(n_chars)::BIGINT AS n_chars, any_value(n_chars) > 1000 AS cut FROM w JOIN n USING (conv_id) WHERE coalesce(before, 0) < 1000 GROUP BY conv_id""")
def entry_reassembly(spark, sf_dir):
    """Conversations put together again, up to 1,000 characters."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("body"))
    return reassembled(rows, ["conv_id"], "turn", "body", 1000).select("conv_id", F.md5("text").alias("digest"), "n_chars", "cut")


@query("""WITH w AS (SELECT conv_id, turn, row_number() OVER o AS n, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS used FROM conversations WINDOW o AS (PARTITION BY conv_id ORDER BY turn)) SELECT * FROM w WHERE n <= 4 AND used <= 1500""")
def budgeted_listing(spark, sf_dir):
    """The first turns of each conversation: four at most, 1,500 characters at most."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return budgeted(rows, ["conv_id"], ["turn"], "text", 1500, 4).select("conv_id", "turn", "n", "used")


@query("""WITH s AS (SELECT source, sqrt(count(*)) AS r FROM documents GROUP BY source), q AS (SELECT source, greatest(1, round_even(100 * r / (SELECT round(sum(r), 9) FROM s), 0)) AS quota FROM s),
r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('0:' || doc_id), doc_id) AS k FROM documents) SELECT doc_id, source FROM r JOIN q USING (source) WHERE k <= quota""")
def stratified_sample(spark, sf_dir):
    """About a hundred documents, by the square root of the size of their sources."""
    return P.stratified(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], "doc_id", 100).select("doc_id", "source")


@query("""WITH a AS (SELECT doc_id AS path, length(text) AS size, sha256(text) AS sha FROM documents WHERE doc_id % 7 <> 0), b AS (SELECT doc_id AS path, length(t) AS size, sha256(t) AS sha FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN text || '.' WHEN doc_id % 11 = 0 THEN replace(text, 'e', 'a') ELSE text END AS t FROM documents WHERE doc_id % 13 <> 0)),
s AS (SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'gone' WHEN a.path IS NULL THEN 'new' WHEN a.size <> b.size THEN 'size' WHEN a.sha <> b.sha THEN 'content' ELSE 'same' END AS state FROM a FULL JOIN b ON a.path = b.path) SELECT state, count(*) AS n, min(path) AS first_path FROM s WHERE state <> 'same' GROUP BY state""")
def staleness_outer(spark, sf_dir):
    """Documents against a changed copy: gone, new, other size, other content."""
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    changed = F.when(F.col("path") % 5 == 0, F.concat("text", F.lit("."))).when(F.col("path") % 11 == 0, F.replace("text", F.lit("e"), F.lit("a"))).otherwise(F.col("text"))
    shape = lambda df: df.select("path", F.length("text").alias("size"), F.sha2("text", 256).alias("sha256"))
    found = D.staleness(shape(rows.filter("path % 7 <> 0")), shape(rows.filter("path % 13 <> 0").withColumn("text", changed)))
    return found.groupBy("state").agg(F.count("*").alias("n"), F.min("path").alias("first_path"))


@query("""WITH f AS (
SELECT 'chars-mismatch' AS code, 'WARN' AS severity, doc_id, source AS doc, doc_id::VARCHAR AS example FROM documents WHERE n_chars <> length(text) OR doc_id % 97 = 0
UNION ALL SELECT 'oversized-chunk', 'WARN', doc_id, source, doc_id::VARCHAR FROM documents WHERE length(text) > 20000
UNION ALL SELECT 'breadcrumb-missing', 'FAIL', doc_id, source, lang FROM documents WHERE length(text) < 60
UNION ALL SELECT 'empty-chunk', 'WARN', doc_id, source, doc_id::VARCHAR FROM documents WHERE NOT regexp_matches(lower(text), '[0-9a-z]')),
n AS (SELECT code, severity, count(*) AS n FROM f GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY doc, doc_id, example) AS k FROM f)
SELECT n.code, severity, n, (SELECT string_agg(example, ' | ' ORDER BY k) FROM r WHERE r.code = n.code AND k <= 3) AS examples FROM n""")
def findings_rollup(spark, sf_dir):
    """Checks of documents as sections of their source, rolled up by code."""
    d = table(spark, sf_dir, "documents").withColumn("doc", F.col("source"))
    ident = F.col("doc_id").cast("string")
    return Q.rolled_up(Q.union([
        Q.finding(d, "chars-mismatch", (F.col("n_chars") != F.length("text")) | (F.col("doc_id") % 97 == 0), "doc_id", ident),
        Q.finding(d, "oversized-chunk", F.length("text") > 20000, "doc_id", ident),
        Q.finding(d, "breadcrumb-missing", F.length("text") < 60, "doc_id", F.col("lang")),
        Q.finding(d, "empty-chunk", ~F.lower("text").rlike("[0-9a-z]"), "doc_id", ident),
    ]))


@query(r"""WITH p AS (SELECT page_id % 20 AS doc, page_id AS page, unnest(list_distinct(list_filter(regexp_extract_all(lower(html), '[0-9a-z]+'), lambda x: length(x) >= 4 AND NOT regexp_full_match(x, '[0-9]+')))) AS word FROM pages),
c AS (SELECT DISTINCT doc_id % 20 AS doc, unnest(regexp_extract_all(lower(text), '[0-9a-z]+')) AS word FROM documents)
SELECT doc, page, count(*) AS n_words, round(count(c.word) / count(*), 6) AS share FROM p LEFT JOIN c USING (doc, word) GROUP BY doc, page HAVING count(*) >= 20""")
def content_coverage(spark, sf_dir):
    """Words of pages that some document of the same remainder has."""
    pages = table(spark, sf_dir, "pages").select((F.col("page_id") % 20).alias("doc"), F.col("page_id").alias("page"), F.col("html").alias("text"))
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") % 20).alias("doc"), "text")
    return Q.content_coverage(pages, docs, ["doc"])


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS pos FROM documents),
m AS (SELECT doc_id, pos + 1 AS page, sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY pos) - length(line) - 1 AS start FROM l),
o AS (SELECT doc_id, n_chars * k // 4 AS start, n_chars * (k + 1) // 4 AS stop, k AS ord FROM documents, (SELECT unnest([0, 1, 2, 3]) AS k))
SELECT o.doc_id, o.ord, (SELECT max(page) FROM m WHERE m.doc_id = o.doc_id AND m.start <= o.start) AS page_start, (SELECT max(page) FROM m WHERE m.doc_id = o.doc_id AND m.start <= greatest(o.stop - 1, o.start)) AS page_end FROM o""")
def offset_page_asof(spark, sf_dir):
    """Quarters of documents, and the lines (as pages) that they begin and end on."""
    docs = table(spark, sf_dir, "documents")
    marks = docs.select("doc_id", F.posexplode(X.lines("text")).alias("pos", "line"))
    size = F.length("line") + 1
    marks = marks.select("doc_id", (F.col("pos") + 1).cast("long").alias("page"), (F.sum(size).over(Window.partitionBy("doc_id").orderBy("pos")) - size).alias("start"))
    quarters = docs.select("doc_id", "n_chars", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("ord")).selectExpr("doc_id", "cast(ord as long) AS ord", "n_chars * ord div 4 AS start", "n_chars * (ord + 1) div 4 AS stop")
    return T.page_ranges(quarters, marks, ["doc_id"]).select("doc_id", "ord", "page_start", "page_end")


@query()
def chunk_spans(spark, sf_dir):
    """Documents in chunks of at most 2,000 characters: sizes and digests."""
    return T.chunks(table(spark, sf_dir, "documents"), ["doc_id"], "text", 2000, 200).select("doc_id", "ord", "start", "stop", F.md5("body").alias("digest"))


@query("""SELECT doc_id, md5(regexp_replace(text, '\\s+', '', 'g')) AS digest, length(text) > 2000 AS several FROM documents WHERE regexp_replace(text, '\\s+', '', 'g') <> ''""")
def chunk_cover(spark, sf_dir):
    """Chunks have all of each document but blanks, each within its bound, and more than one of them where the text is longer."""
    spans = T.chunks(table(spark, sf_dir, "documents"), ["doc_id"], "text", 2000, 200)
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "body"))), lambda x: x.body), "")
    per = spans.groupBy("doc_id").agg(F.md5(F.regexp_replace(whole, r"[ \t\n\x0B\f\r]+", "")).alias("digest"), F.max(F.col("stop") - F.col("start")).alias("longest"), (F.count("*") > 1).alias("several"))
    return per.filter("longest <= 2000").select("doc_id", "digest", "several")
