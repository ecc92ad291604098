"""Checks of a corpus: each is a table of findings (doc, code, severity, position, example); findings roll up by code.

Checks derive what they need anew from the stored tables, never through the expressions that made them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Codes of checks that fail a corpus; all others warn. And the sizes and shares that checks use.
FAILS = """
manifest-unreadable manifest-missing-field manifest-invalid-field section-without-file section-bad-path section-missing-file
section-unreadable full-md-missing page-invalid breadcrumb-missing breadcrumb-not-rooted breadcrumb-doubled ancestor-not-in-toc
ancestor-contradicts-pages ancestor-not-nested entity-not-in-toc entity-contradicts-pages figures-unreadable figure-file-missing
figure-section-dangling figure-page-invalid page-count-mismatch collection-clash edition-unordered edition-duplicate-version pin-invalid
""".split()
OVERSIZED, NAMED_SHARE, CONTENT_MIN, PAGE_WORDS, SAMPLED = 40_000, 0.90, 0.75, 20, 30
# End of fixed values.

FINDING = ["doc", "code", "severity", "pos", "example"]


def finding(rows: DataFrame, code: str, where: Column, pos: Column | str, example: Column) -> DataFrame:
    """Rows (with a column doc) that a check is about."""
    at = F.col(pos) if isinstance(pos, str) else pos
    severity = "FAIL" if code in FAILS else "WARN"
    return rows.filter(where).select("doc", F.lit(code).alias("code"), F.lit(severity).alias("severity"), at.cast("long").alias("pos"), F.coalesce(example.cast("string"), F.lit("")).alias("example"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rolled_up(findings: DataFrame, examples: int = 3) -> DataFrame:
    """(code, severity, n, examples): counts, and the first examples by document and position. A window keeps so few of each code before they are gathered."""
    n = findings.groupBy("code", "severity").agg(F.count("*").alias("n"))
    first = findings.withColumn("_r", F.row_number().over(Window.partitionBy("code").orderBy("doc", "pos", "example"))).filter(F.col("_r") <= examples)
    texts = first.groupBy("code").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_r", "example"))), lambda x: x["example"]), " | ").alias("examples"))
    return n.join(texts, "code")


def exit_status(findings: DataFrame, strict: bool = False) -> int:
    worst = findings.filter(F.lit(True) if strict else F.col("severity") == "FAIL").limit(1).count()
    return int(worst > 0)


def manifest_checks(manifests: DataFrame) -> DataFrame:
    """manifests (doc, folder, slug, title, source_pdf, page_count, toc, sections, bad)."""
    m, zero = manifests, F.lit(0)
    parts = [finding(m, "manifest-unreadable", F.col("bad"), zero, F.col("folder"))]
    ok = m.filter(~F.col("bad"))
    for name in ("source_pdf", "title", "slug"):
        parts.append(finding(ok, "manifest-missing-field", F.col(name).isNull(), zero, F.lit(name)))
        parts.append(finding(ok, "manifest-invalid-field", F.trim(name) == "", zero, F.lit(name)))
    for name, wrong in (("page_count", F.col("page_count") < 1), ("sections", F.size("sections") == 0)):
        parts.append(finding(ok, "manifest-missing-field", F.col(name).isNull(), zero, F.lit(name)))
        parts.append(finding(ok, "manifest-invalid-field", wrong, zero, F.lit(name)))
    parts.append(finding(ok, "slug-mismatch", F.col("slug") != F.col("folder"), zero, F.col("slug")))
    parts.append(finding(ok, "toc-missing", F.coalesce(F.size("toc"), F.lit(0)) <= 0, zero, F.col("title")))
    return union(parts)


def section_checks(sections: DataFrame, files: DataFrame) -> DataFrame:
    """sections (doc, ord, file, chars, page_start, page_end, page_count), files (doc, file, text; null: not UTF-8)."""
    bad_path = ~F.regexp_replace("file", r"\\", "/").rlike("^sections/.") | F.col("file").rlike(r"(^|[/\\])\.\.([/\\]|$)")
    empty = F.coalesce(F.col("file"), F.lit("")) == ""
    s = sections.withColumn("_dup", F.row_number().over(Window.partitionBy("doc", "file").orderBy("ord")))
    met = s.filter(~empty).join(files.withColumn("_there", F.lit(True)), ["doc", "file"], "left")
    pages = F.col("page_start").isNotNull() | F.col("page_end").isNotNull()
    bad_pages = pages & ~F.coalesce((F.col("page_start") >= 1) & (F.col("page_start") <= F.col("page_end")) & (F.col("page_end") <= F.col("page_count")), F.lit(False))
    before = F.last(F.when(~bad_pages, F.col("page_start")), ignorenulls=True).over(Window.partitionBy("doc").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    orphans = files.join(sections.select("doc", "file").distinct(), ["doc", "file"], "left_anti")
    ok = (~bad_pages & F.col("page_start").isNotNull()).cast("int")
    share = sections.groupBy("doc").agg(F.sum(ok).alias("_n"), F.count("*").alias("_all"))
    return union([
        finding(s, "section-without-file", empty, "ord", F.col("ord")),
        finding(s, "section-bad-path", ~empty & bad_path, "ord", F.col("file")),
        finding(s, "section-duplicate-file", ~empty & (F.col("_dup") > 1), "ord", F.col("file")),
        finding(met, "section-missing-file", F.col("_there").isNull() & ~bad_path, "ord", F.col("file")),
        finding(met, "section-unreadable", F.col("_there") & F.col("text").isNull(), "ord", F.col("file")),
        finding(orphans, "section-orphan-file", F.lit(True), F.lit(0), F.col("file")),
        finding(met, "chars-mismatch", F.col("chars") != F.length("text"), "ord", F.col("file")),
        finding(met, "oversized-chunk", F.length("text") > OVERSIZED, "ord", F.col("file")),
        finding(met, "empty-chunk", F.col("text").isNotNull() & ~F.lower("text").rlike("[0-9a-z]"), "ord", F.col("file")),
        finding(s, "page-invalid", bad_pages, "ord", F.concat_ws("-", "page_start", "page_end")),
        finding(s.withColumn("_before", before), "pages-backwards", ~bad_pages & (F.col("page_start") < F.col("_before")), "ord", F.col("file")),
        finding(share, "no-pages", F.col("_n") == 0, F.lit(0), F.col("_all")),
        finding(share, "pages-partial", (F.col("_n") > 0) & (F.col("_n") < F.col("_all")), F.lit(0), F.concat_ws("/", "_n", "_all")),
    ])


def breadcrumb_checks(sections: DataFrame, crumb: str = " › ") -> DataFrame:
    """sections (doc, ord, title, breadcrumb, first_lines: the first two lines that aren't blank)."""
    blank = F.trim(F.coalesce(F.col("breadcrumb"), F.lit(""))) == ""
    rooted = (F.col("breadcrumb") == F.col("title")) | F.col("breadcrumb").startswith(F.concat(F.col("title"), F.lit(crumb)))
    shaped = lambda i: F.coalesce(F.get("first_lines", F.lit(i)).startswith(F.concat(F.lit("*"), F.col("title"))) & F.get("first_lines", F.lit(i)).endswith("*"), F.lit(False))
    return union([
        finding(sections, "breadcrumb-missing", blank, "ord", F.col("ord")),
        finding(sections, "breadcrumb-not-rooted", ~blank & ~rooted, "ord", F.col("breadcrumb")),
        finding(sections, "breadcrumb-doubled", shaped(0) & shaped(1), "ord", F.get("first_lines", F.lit(1))),
        finding(sections, "breadcrumb-file-mismatch", ~blank & (F.get("first_lines", F.lit(0)) != F.concat(F.lit("*"), F.col("breadcrumb"), F.lit("*"))), "ord", F.col("breadcrumb")),
    ])


def figure_checks(figures: DataFrame, sections: DataFrame, files: DataFrame) -> DataFrame:
    """figures (doc, id, file, section, page, page_count), sections (doc, file, page_start, page_end), files (doc, file)."""
    s = sections.select("doc", F.col("file").alias("section"), "page_start", "page_end", F.lit(True).alias("_s"))
    f = figures.join(files.select("doc", "file").distinct().withColumn("_f", F.lit(True)), ["doc", "file"], "left").join(s, ["doc", "section"], "left")
    return union([
        finding(f, "figure-file-missing", F.col("_f").isNull(), F.lit(0), F.col("id")),
        finding(f, "figure-section-dangling", F.col("section").isNotNull() & F.col("_s").isNull(), F.lit(0), F.col("id")),
        finding(f, "figure-page-invalid", ~F.coalesce(F.col("page").between(F.lit(1), F.col("page_count")), F.lit(False)), F.lit(0), F.col("id")),
        finding(f, "figure-outside-section", ~F.col("page").between(F.col("page_start"), F.col("page_end")), F.lit(0), F.col("id")),
    ])


def toc_checks(chunks: DataFrame, spans: DataFrame, key: Column, owner: str = "entity") -> DataFrame:
    """chunks (doc, ord, page_start, page_end, ancestors, entity), spans (doc, title_key, rank, page, end_page); key makes a title_key of column `name`."""
    up = chunks.select("doc", "ord", "page_start", "page_end", F.posexplode("ancestors").alias("depth", "name")).withColumn("title_key", key)
    own = chunks.filter(F.col(owner).isNotNull()).select("doc", "ord", "page_start", "page_end", F.col(owner).alias("name")).withColumn("title_key", key)

    def verdict(rows: DataFrame, by: list[str]) -> DataFrame:
        met = rows.join(spans.select("doc", "title_key", "page", "end_page"), ["doc", "title_key"], "left")
        over = (F.col("page") <= F.col("page_end")) & (F.col("end_page").isNull() | (F.col("end_page") >= F.col("page_start")))
        return met.groupBy("doc", "ord", *by, "name").agg(F.bool_or(over).alias("over"), F.max("page").alias("_known"), F.max("page_start").alias("_paged"))

    a, e = verdict(up, ["depth"]), verdict(own, [])
    lost = F.col("_known").isNull()
    against = ~lost & F.col("_paged").isNotNull() & ~F.coalesce(F.col("over"), F.lit(True))
    one = a.filter(against).groupBy("doc", "ord").agg(F.min_by("name", "depth").alias("name"))
    return union([
        finding(a, "ancestor-not-in-toc", lost, "ord", F.col("name")),
        finding(one, "ancestor-contradicts-pages", F.lit(True), "ord", F.col("name")),
        finding(e, "entity-not-in-toc", lost, "ord", F.col("name")),
        finding(e, "entity-contradicts-pages", against, "ord", F.col("name")),
    ])


def content_coverage(pages: DataFrame, chunks: DataFrame, doc: list[str], page: str = "page", words_of=None, least: int = PAGE_WORDS) -> DataFrame:
    """(doc, page, n_words, share): of the distinct words of a page, the share that some chunk of the document has. Pages of few words aren't judged."""
    from folioscan.functions import text as X

    own = words_of or X.content_words
    p = pages.select(*doc, page, F.explode(own("text")).alias("word"))
    c = chunks.select(*doc, F.explode(own("text")).alias("word")).distinct().withColumn("_in", F.lit(1))
    met = p.join(c, [*doc, "word"], "left").groupBy(*doc, page).agg(F.count("*").alias("n_words"), F.round(F.count("_in") / F.count("*"), 6).alias("share"))
    return met.filter(F.col("n_words") >= least)


# Checks beside those above, each from stored tables alone.

# Chunks and shares that make a page label or a title furniture; what a folder that tools skip is called.
FOOTER_CHUNKS, FOOTER_SHARE, FOOTER_VARIETY, TITLE_CHUNKS = 10, 0.10, 0.5, 3
SKIPPED = r"\.(old|new)$|^[._]"
# End of fixed values.


def words_of(text: Column | str) -> Column:
    """A text as its letters and digits in lower case, one blank between runs and at both ends: whole phrases are contained in it as they are."""
    t = F.col(text) if isinstance(text, str) else text
    return F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(F.lower(F.coalesce(t, F.lit(""))), F.lit("[0-9a-z]+"), F.lit(0)), " "), F.lit(" "))


def release_numbers(version: Column | str) -> Column:
    """The numbers of a release as text that sorts as they do, worked out digit run by digit run: not by the expressions that order editions."""
    v = F.upper(F.translate(F.regexp_replace(F.coalesce(F.col(version) if isinstance(version, str) else version, F.lit("")), r"\s+", ""), "_", "."))
    v = F.regexp_replace(v, "^V(?=[0-9])", "")
    at = F.regexp_instr(v, F.lit(r"20[0-9]{2}\.[0-9]{1,2}"))
    tail = F.substring(v, F.greatest(at, F.lit(1)), F.length(v))
    head = F.regexp_replace(tail, r"^(20[0-9]{2}\.[0-9]{1,2}(?:\.[0-9]+)*).*$", "$1")
    pad = lambda x: F.lpad(F.regexp_replace(x, "^0+(?=[0-9])", ""), 12, "0")
    pack = F.split(F.regexp_replace(F.regexp_extract(v, r"SP([0-9]+(?:-[0-9]+)?)", 1), "^$", "0"), "-")
    dated = F.concat_ws(".", F.transform(F.split(head, r"\."), pad), F.lit("-"), pad(F.get(pack, F.lit(0))), pad(F.coalesce(F.get(pack, F.lit(1)), F.lit("0"))))
    plain = F.array_join(F.transform(F.filter(F.split(v, "[^0-9]+"), lambda x: x != ""), pad), ".")
    return F.when(at > 0, dated).otherwise(F.nullif(plain, F.lit("")))


def document_checks(manifests: DataFrame, files: DataFrame, pdfs: DataFrame, figures: DataFrame | None = None) -> DataFrame:
    """Files that a document needs: full.md, its source PDF with as many pages as the manifest says, readable figures; and a conversion that named no entry.

    manifests (doc, collection, source_pdf, page_count, attribution_status), files (doc, file), pdfs (collection, place, name, page_count; null where it can't be opened), figures (doc, bad).
    """
    full = files.filter("file = 'full.md'").select("doc").distinct().withColumn("_full", F.lit(True))
    own = pdfs.filter("place in ('source', 'root')").groupBy("collection", F.col("name").alias("source_pdf")).agg(F.min_by(F.struct(F.col("page_count").alias("n")), F.when(F.col("place") == "source", 0).otherwise(1)).alias("_pdf"))
    m = manifests.join(full, "doc", "left").join(own, ["collection", "source_pdf"], "left")
    pages = F.col("_pdf.n")
    parts = [
        finding(m, "full-md-missing", F.col("_full").isNull(), F.lit(0), F.col("doc")),
        finding(m, "source-pdf-missing", F.col("_pdf").isNull(), F.lit(0), F.col("source_pdf")),
        finding(m, "content-unchecked", F.col("_pdf").isNotNull() & pages.isNull(), F.lit(0), F.col("source_pdf")),
        finding(m, "page-count-mismatch", pages != F.col("page_count"), F.lit(0), F.concat_ws(" and ", F.col("page_count").cast("string"), pages.cast("string"))),
        finding(m, "attribution-declined", F.col("attribution_status") == "declined", F.lit(0), F.col("doc")),
    ]
    if figures is not None:
        parts.append(finding(figures.filter("bad").select("doc").distinct(), "figures-unreadable", F.lit(True), F.lit(0), F.col("doc")))
    return union(parts)


def label_checks(chunks: DataFrame, toc: DataFrame, spans: DataFrame) -> DataFrame:
    """Breadcrumbs and owners against the outline and each other.

    chunks (doc, ord, file, heading, entity, ancestors, body, page_start, page_end), toc (doc: those with an outline), spans (doc, title_key, rank, end_rank, page, end_page); title keys are words_of.
    """
    has = toc.select("doc").distinct().withColumn("_toc", F.lit(True))
    c = chunks.join(has, "doc", "left").withColumn("_owner", F.when(F.trim("entity") != "", words_of("entity")))
    deep = F.size(F.coalesce("ancestors", F.array().cast("array<string>"))) > 0
    owners = c.filter("_owner is not null").select("doc", F.col("_owner").alias("_head")).distinct().withColumn("_owns", F.lit(True))
    headed = c.withColumn("_head", words_of(F.regexp_replace("heading", r"\(intro\)", ""))).join(owners, ["doc", "_head"], "left")
    named = F.when(F.col("_owner").isNotNull(), words_of("body").contains(F.col("_owner")))
    share = c.withColumn("_named", named).groupBy("doc").agg(F.count("_named").alias("_n"), F.count_if("_named").alias("_k"), F.min(F.when(~F.col("_named"), F.col("file"))).alias("_first"))
    # Ancestors in order, with those of the outline that can be meant; the owner ends the chain where the breadcrumb doesn't.
    full = F.when(F.col("_owner").isNull() | (F.coalesce(words_of(F.element_at("ancestors", -1)) == F.col("_owner"), F.lit(False))), F.coalesce("ancestors", F.array().cast("array<string>"))).otherwise(F.concat(F.coalesce("ancestors", F.array().cast("array<string>")), F.array("entity")))
    steps = c.filter("_toc").select("doc", "ord", "page_start", "page_end", F.posexplode(full).alias("depth", "name")).withColumn("title_key", words_of("name"))
    met = steps.join(spans.select("doc", "title_key", "rank", "end_rank", "page", "end_page"), ["doc", "title_key"])
    fits = F.col("page_start").isNull() | F.col("page").isNull() | ((F.col("page") <= F.col("page_end")) & (F.col("end_page").isNull() | (F.col("end_page") >= F.col("page_start"))))
    met = met.withColumn("_fits", fits)
    # Where none of a title's entries fits the pages, it is no link of the chain: that has a check of its own.
    chain = met.filter("_fits").groupBy("doc", "ord", "depth", "title_key").agg(F.collect_list(F.struct("rank", "end_rank")).alias("spots"))
    w = Window.partitionBy("doc", "ord").orderBy("depth")
    pairs = chain.withColumn("_in", F.lead("spots").over(w)).filter("_in is not null")
    nests = F.exists("spots", lambda o: F.exists("_in", lambda i: o["rank"].isNull() | i["rank"].isNull() | ((o["rank"] < i["rank"]) & (i["rank"] < o["end_rank"]))))
    return union([
        finding(c, "ancestor-unverifiable", deep & F.col("_toc").isNull(), "ord", F.array_join("ancestors", " › ")),
        finding(pairs.filter(~nests).select("doc", "ord").distinct(), "ancestor-not-nested", F.lit(True), "ord", F.col("ord")),
        finding(headed, "entity-heading-mismatch", F.col("_owns") & F.col("_owner").isNotNull() & (F.col("_head") != F.col("_owner")), "ord", F.concat_ws(" / ", "heading", "entity")),
        finding(c, "entity-breadcrumb-mismatch", F.col("_owner").isNotNull() & F.col("ancestors").isNotNull() & (~deep | (words_of(F.element_at("ancestors", -1)) != F.col("_owner"))), "ord", F.col("entity")),
        finding(share, "entity-rarely-named", (F.col("_n") > 0) & (F.col("_k") < NAMED_SHARE * F.col("_n")), F.lit(0), F.concat_ws("/", "_k", "_n")),
    ])


def order_checks(chunks: DataFrame, spans: DataFrame) -> DataFrame:
    """Chunks whose deepest ancestor stands before where the last ones were: chunks (doc, ord, ancestors), spans (doc, title_key, rank, end_rank)."""
    from .outline import out_of_order

    own = chunks.filter(F.size("ancestors") > 0).select("doc", F.col("ord").cast("long").alias("ord"), words_of(F.element_at("ancestors", -1)).alias("title_key"))
    return finding(out_of_order(own, spans, ["doc"]), "ancestor-out-of-order", F.lit(True), "ord", F.concat_ws(" after ", F.col("back_to").cast("string"), F.col("after").cast("string")))


def furniture_checks(chunks: DataFrame) -> DataFrame:
    """Chunks with page furniture left in them: a feedback link, the title as a line in three chunks, a page label that many chunks have with other numbers. chunks (doc, ord, title, body)."""
    lines = chunks.select("doc", "ord", words_of("title").alias("_title"), F.explode(F.split(F.coalesce("body", F.lit("")), "\n")).alias("_l")).withColumn("_k", words_of("_l")).filter("_k <> '  '")
    feedback = lines.filter("_k = ' feedback '").select("doc", "ord").distinct()
    titled = lines.filter("_k = _title").select("doc", "ord").distinct()
    often = titled.groupBy("doc").agg(F.count("*").alias("n")).filter(F.col("n") >= TITLE_CHUNKS).select("doc")
    plain = F.regexp_replace(F.trim("_l"), r"[*`]+", "")
    shaped = lines.filter(plain.rlike(r"[0-9]") & plain.rlike(r"[A-Za-z]{2,}[^A-Za-z]+(?:[A-Za-z]{2,})|[A-Za-z]{2,}.*[ \t][A-Za-z]{2,}") & ~plain.rlike(r"_|(?:^|[ \t])[-<\[({`](?![0-9])|[A-Za-z]{2,}[0-9]|[0-9][A-Za-z]"))
    masked = shaped.select("doc", "ord", plain.alias("_raw"), F.regexp_replace(plain, "[0-9]+", "#").alias("_m")).distinct()
    sizes = chunks.groupBy("doc").agg(F.count("*").alias("_all"))
    per = masked.groupBy("doc", "_m").agg(F.count_distinct("ord").alias("_in"), F.count_distinct("_raw").alias("_kinds")).join(sizes, "doc")
    labels = per.filter((F.col("_in") >= F.greatest(F.lit(FOOTER_CHUNKS), FOOTER_SHARE * F.col("_all"))) & (F.col("_kinds") >= FOOTER_VARIETY * F.col("_in"))).select("doc", "_m")
    dirty = feedback.union(titled.join(often, "doc", "left_semi")).union(masked.join(labels, ["doc", "_m"], "left_semi").select("doc", "ord")).distinct()
    return finding(dirty, "furniture", F.lit(True), "ord", F.col("ord"))


def content_checks(coverage: DataFrame) -> DataFrame:
    """Pages of whose words too few are in the chunks: coverage (doc, page, share), see content_coverage."""
    return finding(coverage, "content-gap", F.col("share") < CONTENT_MIN, "page", F.concat_ws(" ", F.col("page").cast("string"), F.col("share").cast("string")))


def collection_checks(folders: DataFrame, manifests: DataFrame, catalog: DataFrame | None, pdfs: DataFrame, superseded: DataFrame) -> DataFrame:
    """Folders and lists of a collection.

    folders (doc, collection, folder, name, has_manifest: what lies under docs/), manifests (collection, slug, source_pdf, title, page_count, doc_id, version), catalog: docs/index.json with the same
    columns (null: there is none), pdfs (collection, place, name), superseded (collection, file, superseded_by; null fields where an entry lacks them).
    """
    key = F.regexp_replace(F.regexp_replace(F.lower("folder"), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    clash = folders.select("folder", key.alias("doc")).distinct().groupBy("doc").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("folder")), ", ").alias("f")).filter("n > 1")
    hidden = folders.filter(F.col("has_manifest") & F.col("name").rlike(SKIPPED))
    parts = [finding(clash, "collection-clash", F.lit(True), F.lit(0), F.col("f")), finding(hidden, "hidden-document", F.lit(True), F.lit(0), F.col("name"))]
    known = manifests.select("collection", F.col("slug").alias("superseded_by")).distinct().withColumn("_known", F.lit(True))
    converted = manifests.select("collection", F.col("source_pdf").alias("file")).distinct().withColumn("_done", F.lit(True))
    s = superseded.join(known, ["collection", "superseded_by"], "left").join(converted, ["collection", "file"], "left").withColumn("doc", F.col("collection"))
    parts.append(finding(s, "superseded-invalid", F.col("file").isNull() | F.col("superseded_by").isNull() | F.col("_known").isNull() | F.coalesce("_done", F.lit(False)), F.lit(0), F.coalesce("file", "superseded_by", F.lit("an entry"))))
    listed = superseded.select("collection", F.col("file").alias("name")).filter("name is not null").union(manifests.select("collection", "source_pdf")).distinct()
    loose = pdfs.filter("place in ('source', 'root')").select("collection", "name").distinct().join(listed, ["collection", "name"], "left_anti").withColumn("doc", F.col("collection"))
    parts.append(finding(loose, "pdf-unaccounted", F.lit(True), F.lit(0), F.col("name")))
    if catalog is not None:
        fields = ["source_pdf", "title", "page_count", "doc_id", "version"]
        have = catalog.select("collection").distinct()
        parts.append(finding(manifests.select("collection").distinct().join(have, "collection", "left_anti").withColumn("doc", F.col("collection")), "index-missing", F.lit(True), F.lit(0), F.col("doc")))
        a = manifests.select("collection", "slug", F.struct(*fields).alias("a")).join(have, "collection", "left_semi")
        b = catalog.select("collection", "slug", F.struct(*fields).alias("b"))
        stale = a.join(b, ["collection", "slug"], "full_outer").withColumn("doc", F.col("collection"))
        which = F.array_join(F.filter(F.array(*[F.when(~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")), f) for f in fields]), lambda x: x.isNotNull()), ", ")
        parts.append(finding(stale, "index-stale", ~F.col("a").eqNullSafe(F.col("b")), F.lit(0), F.concat_ws(": ", "slug", F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), which).when(F.col("a").isNull(), "no document").otherwise("not listed"))))
    else:
        parts.append(finding(manifests.select(F.col("collection").alias("doc")).distinct(), "index-missing", F.lit(True), F.lit(0), F.col("doc")))
    return union(parts)


def edition_checks(documents: DataFrame, pins: DataFrame) -> DataFrame:
    """Editions worked out anew: documents (collection, doc_id, slug, title, version), pins (collection, doc_id, version)."""
    d = documents.withColumn("_key", release_numbers("version")).withColumn("doc", F.concat_ws("/", "collection", "doc_id"))
    per = d.groupBy("doc").agg(F.count("*").alias("n"), F.count("_key").alias("k"))
    twice = d.filter("_key is not null").groupBy("doc", "_key").agg(F.count("*").alias("n"), F.min("version").alias("version"))
    title = F.trim(F.regexp_replace(F.lower("title"), "[^0-9a-z]+", " "))
    alike = d.groupBy(F.col("collection").alias("doc"), title.alias("t")).agg(F.count_distinct("doc_id").alias("n"))
    editions = d.groupBy("collection", "doc_id").agg(F.collect_set("_key").alias("_keys"), F.collect_set(F.upper("version")).alias("_names"))
    p = pins.join(editions, ["collection", "doc_id"], "left").withColumn("doc", F.col("collection"))
    fits = F.array_contains("_keys", release_numbers("version")) | F.array_contains("_names", F.upper("version"))
    return union([
        finding(per, "edition-unordered", (F.col("n") > 1) & (F.col("k") < F.col("n")), F.lit(0), F.col("doc")),
        finding(twice, "edition-duplicate-version", F.col("n") > 1, F.lit(0), F.col("version")),
        finding(alike, "edition-ungrouped", (F.col("n") > 1) & (F.col("t") != ""), F.lit(0), F.col("t")),
        finding(p, "pin-invalid", F.col("version").isNull() | F.col("_keys").isNull() | ~F.coalesce(fits, F.lit(False)), F.lit(0), F.concat_ws(" ", "doc_id", "version")),
    ])
