"""Operators that the driver's tables don't exercise, on small inline fixtures."""

import json
import sqlite3

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscan.functions import text as X
from folioscan.functions.udfs import porter
from folioscan.operators import compare, editions, lookup, quality, script_lint, structure
from folioscan.operators import search as S
from folioscan.sources import corpus
from folioscan.streaming import calls as streaming


def one(spark, col, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(col.alias("x")).first().x


@pytest.mark.parametrize("version, key", [("2026.1", [2026, 1, -1, 0, 0]), ("2026.1.1", [2026, 1, 1, -1, 0, 0]), ("Y-2026.03-SP2", [2026, 3, -1, 2, 0]), ("v2025_2", [2025, 2, -1, 0, 0]), ("2020.09-SP3-2", [2020, 9, -1, 3, 2]), ("3.14b", [3, 14]), ("draft", None), (None, None)])
def test_version_keys(spark, version, key):
    assert one(spark, X.version_key("v"), v=version) == key


@pytest.mark.parametrize("heading, body, noise", [("Contents", "", True), ("Index (cont.)", "", True), ("Index Types", "", False), ("About This Guide", "", True), ("Rules", "a . . . . 1\nb . . . . 2\nc\nd", True), ("Rules", "a . . . . 1\nb\nc\nd\ne", False)])
def test_front_matter(spark, heading, body, noise):
    assert one(spark, X.is_noise("h", "b"), h=heading, b=body) is noise


def test_text_expressions(spark):
    assert one(spark, X.identifiers("t"), t="use `set_clock`, -period and ADES-002. plain") == ["set_clock", "-period", "ades-002"]
    assert one(spark, X.match_terms("t"), t="How do I define a clock") == ["define", "clock"]
    assert one(spark, X.match_terms("t"), t="how do I") == ["how", "do", "i"]
    assert one(spark, X.clean_heading("t"), t="***Bold***") == "Bold" and one(spark, X.clean_heading("t"), t="**") == "**"
    assert one(spark, X.entity_keys("t"), t="Rule  C1") == ["rule c1", "c1", "drc rule c1"]
    assert one(spark, X.split_crumb("c", "t"), c="Man › A › B", t="Man") == ["A", "B"] and one(spark, X.split_crumb("c", "t"), c="Other › A", t="Man") is None
    assert one(spark, X.without_crumb("b", "c"), b="*Man › A*\nbody", c="Man › A") == "body"
    assert [one(spark, X.skipped_name("n"), n=n) for n in ("x.old", "x.new", ".x", "_x", "x", "a.b", "x.older", "x.new.bak")] == [True] * 4 + [False] * 4
    assert [one(spark, X.safe_path("p"), p=p) for p in ("sections/a.md", "sections/../a", "/etc/x", "other/a")] == [True, False, False, False]
    assert [one(spark, X.valid_pages("s", "e", "n"), s=s, e=e, n=9) for s, e in ((1, 2), (3, 2), (8, 10))] == ["ok", "invalid", "invalid"]


def test_stems_are_those_of_the_full_text_index():
    con = sqlite3.connect(":memory:")
    try:
        con.execute("CREATE VIRTUAL TABLE t USING fts5(x, tokenize='porter unicode61')")
        con.execute("CREATE VIRTUAL TABLE v USING fts5vocab(t, 'row')")
    except sqlite3.OperationalError:
        pytest.skip("SQLite without FTS5")
    words = "caresses ponies ties cats feed agreed plastered motoring sing conflated troubled sized hopping falling hissing fizzed failing filing happy sky relational conditional rational digitizer conformably radically differently vilely analogously operator feudalism decisiveness hopefulness formality sensitivity triplicate formative formalize electrical goodness revival allowance inference airliner adjustable defensible replacement adjustment dependent adoption communism activate homologous effective bowdlerize probate rate cease controlling roll by is clocks timing constraints defined".split()
    for w in words:
        con.execute("DELETE FROM t")
        con.execute("INSERT INTO t VALUES (?)", (w,))
        assert con.execute("SELECT term FROM v").fetchall() == [(porter(w),)]


def test_bm25_is_the_full_text_indexes(spark):
    con = sqlite3.connect(":memory:")
    try:
        con.execute("CREATE VIRTUAL TABLE t USING fts5(heading, body, tokenize='unicode61')")
    except sqlite3.OperationalError:
        pytest.skip("SQLite without FTS5")
    rows = [(k, f"head {k % 3} clock", " ".join(f"w{(k * j) % 11}" for j in range(1, 9 + k % 5))) for k in range(1, 40)]
    con.executemany("INSERT INTO t (rowid, heading, body) VALUES (?, ?, ?)", rows)
    docs = spark.createDataFrame(rows, "doc_id int, heading string, body string")
    asked = spark.createDataFrame([(1, ["w3", "w5"]), (2, ["clock", "w7"])], "qid int, terms array<string>")
    got = {(r.qid, r.doc_id): r.score for r in S.bm25(asked, docs, ["doc_id"], {"heading": 10, "body": 1}).collect()}
    want = {(q, i): round(-s, 6) for q, m in ((1, "w3 OR w5"), (2, "clock OR w7")) for i, s in con.execute("SELECT rowid, bm25(t, 10.0, 1.0) FROM t WHERE t MATCH ?", (m,))}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) <= 2e-6 for k in want)


def test_search_prefers_current_and_entities(spark):
    rows = [("c", "a", 0, "Intro", None, "A", "set the clock with care " * 20, "", True), ("c", "a", 1, "set_clock", "set_clock", "A", "set_clock defines a clock " * 20, "", True), ("c", "old", 0, "set_clock", "set_clock", "A", "set_clock defines a clock " * 20, "", False)]
    chunks = spark.createDataFrame(rows, "collection string, slug string, ord int, heading string, entity string, breadcrumb string, body string, figures string, is_current boolean")
    found = S.search(spark.createDataFrame([(1, "how do I use set_clock")], "qid int, query string"), chunks).orderBy("rank").collect()
    assert [(r.slug, r.ord) for r in found][0] == ("a", 1) and all(r.slug == "a" for r in found)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #\n`é.", max_size=400), st.integers(20, 90))
def test_chunks_make_up_the_text(text, most):
    spans = structure.chunk_spans(text, most, 10)
    # Blank lines between pieces belong to none; all else is in one of them, in order.
    edges = [0, *(x for _, _, a, b in spans for x in (a, b)), len(text)]
    assert edges == sorted(edges) and not any(text[a:b].strip() for a, b in zip(edges[::2], edges[1::2], strict=True))
    assert all(0 < b - a <= most for _, _, a, b in spans)


def test_chunks_cut_at_headings():
    text = "# One\n" + "x" * 600 + "\n## Two\n" + "y" * 600 + "\n```\n# no heading\n```\n# Three\n" + "z" * 600
    assert [t for t, *_ in structure.chunk_spans(text)] == ["One", "Two", "Three"]


def test_editions_pins_and_undecided(spark):
    docs = spark.createDataFrame([("c", "m", "m-1", "2025.1", True), ("c", "m", "m-2", "2026.1", False), ("c", "n", "n-1", "2025.1", False), ("c", "n", "n-2", "draft", False), ("c", "o", "o-1", None, False)], "collection string, doc_id string, slug string, version string, version_later boolean")
    current = {r.slug: r.is_current for r in editions.resolved(docs).collect()}
    assert current == {"m-1": False, "m-2": True, "n-1": None, "n-2": None, "o-1": True}
    pins = spark.createDataFrame([("c", "m", "2025.1")], "collection string, doc_id string, version string")
    assert {r.slug for r in editions.resolved(docs, pins).filter("is_current").collect()} == {"m-1", "o-1"}
    assert [(r.doc_id, r.problem) for r in editions.problems(docs).collect()] == [("n", "edition-unordered")]
    asked = spark.createDataFrame([(1, "c", "m", "2025.3"), (2, "c", "m", "2026.4"), (3, "c", "m", "2020.1"), (4, "c", "m", "2026.1")], "request int, collection string, doc_id string, version string")
    assert {r.request: (r.slug, r.how) for r in editions.as_of(asked, docs).collect()} == {1: ("m-1", "earlier, and later"), 2: (None, "not covered"), 3: (None, "no edition"), 4: ("m-2", "exact")}


def test_ambiguous_headings_get_no_ancestors(spark):
    toc = spark.createDataFrame([("d", 1, 1, "A", 1), ("d", 2, 2, "Setup", 2), ("d", 3, 1, "B", 5), ("d", 4, 2, "Setup", 6), ("d", 5, 2, "Usage", 7)], "doc string, idx int, level int, title string, page int")
    chunks = spark.createDataFrame([("d", 0, "Setup", "M"), ("d", 1, "Usage", "M"), ("d", 2, "Unknown", "M")], "doc string, ord int, heading string, title string")
    assert [r.breadcrumb for r in structure.breadcrumbs(chunks, toc, ["doc"]).orderBy("ord").collect()] == ["M", "M › B", "M"]


def test_multiset_difference_of_equal_texts_is_empty(spark):
    a = spark.createDataFrame([("d", k % 3, k) for k in range(9)], "doc string, key int, pos int")
    assert compare.only_in(a, a, ["doc"], "key", "pos").count() == 0


def test_scripts_are_lexed():
    script = 'set_clock -period 10 [get_ports -quiet "a -b"]\n# no -x\nif {$a} {\n  add_cells -force \\\n    -all {x -y}\n} else { report }\nproc own {a} { inner }\n$dyn x; last "unclosed'
    found = list(script_lint.calls_of(script))
    assert [(n, ln, k) for n, ln, _, k in found if k == "call"] == [("set_clock", 1, "call"), ("get_ports", 1, "call"), ("add_cells", 4, "call"), ("report", 6, "call"), ("inner", 7, "call"), ("last", 8, "call")]
    assert {n: [o for o, _ in opts] for n, _, opts, k in found if opts} == {"set_clock": ["-period"], "get_ports": ["-quiet"], "add_cells": ["-force", "-all"]}
    assert [n for n, _, _, k in found if k == "proc"] == ["own"] and [n for n, _, _, k in found if k == "dynamic"] == ["$dyn"]
    for bad in ("{{{", "]]]", '"', "\\", "[[[a", "a {b\n\n"):
        list(script_lint.calls_of(bad))


def test_scripts_are_checked(spark):
    entries = spark.createDataFrame([("set_clock", "set_clock -period value -waveform list -name x -negate"), ("report", "report -all")], "name_lower string, text string")
    scripts = spark.createDataFrame([("s", "set_clock -per 3 -n x -bogus\nset_clok 1\nproc own {} {}\nown -z\nreport -all")], "script_id string, text string")
    got = {(r.problem, r.name, r.option): r.suggested for r in script_lint.checked(script_lint.calls(scripts), entries).collect()}
    assert got == {("ambiguous option", "set_clock", "-n"): "-name,-negate", ("unknown option", "set_clock", "-bogus"): None, ("unknown command", "set_clok", None): "set_clock"}


def test_suggestions_see_all_names(spark):
    import difflib

    names = ["create_clock", "create_port", "set_clock", "report_clock", "crate_clocks", "get_cells", "remove_clock", "Ünit_clock"]
    asked = ["reate_clock", "xreate_clock", "rceate_clock", "eport_clock", "nothing like it", "get_", "create_clok"]
    lower = [n.lower() for n in names]
    got = {r.qid: r.suggested for r in lookup.suggestions(spark.createDataFrame([(a, a) for a in [*asked, None]], "qid string, name string"), spark.createDataFrame([(n,) for n in lower], "name_lower string")).collect()}
    want = {a: sorted(n for n in lower if n.startswith(a)) or difflib.get_close_matches(a, lower, n=8, cutoff=0.7) for a in asked}
    assert got == {**want, None: None} and got["reate_clock"][0] == "create_clock"


def test_logs_name_codes_and_rules(spark):
    lines = spark.createDataFrame([("l", 0, "Error: bad (CMD-082)"), ("l", 1, "Warning: Rule S29 (x) was violated"), ("l", 2, "S29 alone"), ("l", 3, "Info: CMD-082 again CMD-082")], "log string, pos int, line string")
    assert {(r.kind, r.code): (r.n_lines, r.first_pos, r.severity) for r in lookup.scan_log(lines, ["log"]).collect()} == {("code", "CMD-082"): (2, 0, 1), ("rule", "S29"): (1, 1, 2)}


SECTIONS = "doc string, ord int, file string, chars int, page_start int, page_end int, page_count int"


@pytest.mark.parametrize("change, code", [((1, "", 4, 1, 1, 9), "section-without-file"), ((1, "sections/../b", 4, 1, 1, 9), "section-bad-path"), ((1, "sections/gone", 4, 1, 1, 9), "section-missing-file"), ((1, "sections/a", 4, 1, 1, 9), "section-duplicate-file"), ((1, "sections/b", 99, 1, 1, 9), "chars-mismatch"), ((1, "sections/b", 4, 5, 2, 9), "page-invalid"), ((1, "sections/bad", 4, 1, 1, 9), "section-unreadable"), ((1, "sections/b", 4, None, None, 9), "pages-partial")])
def test_planted_defects_are_found(spark, change, code):
    files = spark.createDataFrame([("d", "sections/a", "text"), ("d", "sections/b", "more"), ("d", "sections/bad", None)], "doc string, file string, text string")
    good = ("d", 0, "sections/a", 4, 1, 1, 9)
    found = quality.section_checks(spark.createDataFrame([good, ("d", *change)], SECTIONS), files)
    assert code in {r.code for r in found.collect()}
    assert quality.exit_status(found, strict=True) == 1
    clean = quality.section_checks(spark.createDataFrame([good, ("d", 1, "sections/b", 4, 1, 2, 9)], SECTIONS), files.filter("text is not null"))
    assert clean.count() == 0 and quality.exit_status(clean) == 0


def _tree(root):
    doc = root / "My Manuals" / "docs" / "guide-1"
    (doc / "sections").mkdir(parents=True)
    manifest = {"source_pdf": "g.pdf", "title": "Guide", "slug": "guide-1", "page_count": 3, "doc_id": "guide", "version": "2026.1", "toc": [{"level": 1, "title": "A", "page": 1}], "sections": [{"file": "sections/0.md", "heading": "**A**", "page_start": 1, "page_end": 2, "breadcrumb": "Guide › A"}, {"file": "sections/1.md", "heading": "B"}]}
    (doc / "manifest.json").write_text("﻿" + json.dumps(manifest), encoding="utf-8")
    (doc / "sections" / "0.md").write_text("*Guide › A*\nBody of A", encoding="utf-8")
    (doc / "sections" / "1.md").write_bytes(b"\xff\xfe broken")
    for name, text in (("other.old", json.dumps(manifest)), ("broken", "{not json")):
        (root / "My Manuals" / "docs" / name).mkdir()
        (root / "My Manuals" / "docs" / name / "manifest.json").write_text(text)
    (root / "My Manuals" / "current_versions.json").write_text('{"guide": "2026.1"}')


def test_corpus_tree_is_read_and_published(spark, tmp_path):
    _tree(tmp_path / "c")
    root = str(tmp_path / "c")
    found = {r.slug: r.bad for r in corpus.manifests(spark, root).collect()}
    assert found == {"guide-1": False, "broken": True}
    rows = corpus.chunks(spark, root, with_crumb=False).orderBy("ord").collect()
    assert [(r.collection, r.heading, r.body) for r in rows] == [("my-manuals", "A", "Body of A"), ("my-manuals", "B", None)]
    assert [tuple(r) for r in corpus.pins(spark, root).collect()] == [("my-manuals", "guide", "2026.1")]
    assert corpus.sources(spark, root).count() == 4
    for n in (1, 2):
        corpus.write_index(spark, {"chunks": corpus.chunks(spark, root), "t": spark.range(n)}, str(tmp_path / "index"))
    assert corpus.read_index(spark, str(tmp_path / "index"), "t").count() == 2
    docs = spark.createDataFrame([("my-manuals", "guide-1", "guide", "2026.1", False, True, "Guide")], "collection string, slug string, doc_id string, version string, version_and_later boolean, is_current boolean, title string")
    with pytest.raises(ValueError):
        corpus.export_chunks(corpus.chunks(spark, root), docs, str(tmp_path / "x"))
    corpus.export_chunks(corpus.chunks(spark, root).filter("body is not null"), docs, str(tmp_path / "x"))
    assert spark.read.json(str(tmp_path / "x")).first().id == "my-manuals/guide-1/sections/0.md"


def test_json_lines_are_read(spark, tmp_path):
    q = tmp_path / "q.jsonl"
    q.write_text('// note\n\n{"id": "r07", "question": "Q", "answers": []}\n')
    asked = corpus.questions(spark, str(q))
    assert [r.question for r in asked.collect()] == ["Q"] and corpus.next_question_id(asked) == "r08"
    c = tmp_path / "c.jsonl"
    c.write_text('{"t": "2026-01-01T00:00:00Z", "tool": "search", "ms": 5}\n{"trunc\n{"x": 1}\n')
    assert sorted(r.bad for r in corpus.calls(spark, str(c)).collect()) == [False, True, True]


def test_stream_and_table_agree(spark, tmp_path):
    rows = [(f"2026-01-01 0{h}:{m:02d}:00", f"t{m % 2}", float(m), m % 7 == 0) for h in range(4) for m in range(0, 60, 5)]
    table = spark.createDataFrame(rows, "ts string, tool string, ms double, error boolean").withColumn("ts", F.to_timestamp("ts"))
    table.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    streaming.run_available(streaming.by_hour(stream), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {tuple(r) for r in streaming.by_hour(table).collect()}
    assert got <= want and len(got) >= len(want) - 2  # the last hour is open until the watermark passes it
