"""The tools over the tables of a small index."""

from folioscan.operators import compare, index, tools


def _tables(spark):
    toc = [(1, "Guide", 1), (2, "Clocks", 2), (3, "set_clock", 3)]
    docs = spark.createDataFrame(
        [("c", "g-1", "g", "2025.1", True, False, "Guide", toc), ("c", "g-2", "g", "2026.1", False, True, "Guide", toc)],
        "collection string, slug string, doc_id string, version string, version_later boolean, is_current boolean, title string, toc array<struct<level:int,title:string,page:int>>",
    )
    rows = []
    for slug, extra in (("g-1", "Old words."), ("g-2", "New words.")):
        rows += [("c", slug, 0, "sections/0.md", "Clocks", None, "Guide", "A clock tree is described here. " * 12, 1, 2), ("c", slug, 1, "sections/1.md", "set_clock", "set_clock", "Guide › Clocks", f"set_clock -period n -name x\n{extra}\nSets a clock. " + "More of it. " * 20, 3, 3)]
    chunks = spark.createDataFrame(rows, "collection string, slug string, ord int, file string, heading string, entity string, breadcrumb string, body string, page_start int, page_end int")
    figures = spark.createDataFrame([("c", "g-2", "f1", "sections/0.md", "Figure 1. Zebra", None, None, None)], "collection string, slug string, id string, section string, caption string, labels string, ocr string, description string")
    return index.tables(docs, chunks, figures, spark.range(0))


def _asked(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_tools_answer_from_an_index(spark):
    t = {k: v.cache() if k in ("chunks", "postings", "documents") else v for k, v in _tables(spark).items()}
    assert index.health(t["meta"], t["documents"]).first().asDict() == {"status": "ok", "documents": 2, "chunks": 4, "figures": 1}
    assert {(r.slug, r.chunks) for r in index.stats_listing(t["chunks"]).collect()} == {("g-1", 2), ("g-2", 2), (None, 4)}
    schema = "request int, query string, collection string, document string, version string, limit string, cap string"
    asked = _asked(spark, [(1, "set clock", None, None, None, None, None), (2, "zebra", None, None, None, "5", None), (3, "set_clock", "c", "g", "2025.2", None, None), (4, "clock", None, None, "2025.1", None, None), (5, "clock", "c", "g", "2020.1", None, None)], schema)
    got = {}
    for r in tools.search_docs(t, asked).collect():
        got.setdefault(r.request, []).append(r)
    first = min(got[1], key=lambda r: r["rank"])
    assert (first.slug, first.heading) == ("g-2", "set_clock") and all(r.slug == "g-2" for r in got[1]) and "p. 3" in first.cite and "[set" in first.snippet
    assert [(r.slug, r.heading) for r in got[2]] == [("g-2", "Clocks")] and {r.slug for r in got[3]} == {"g-1"}
    assert "needs `document`" in got[4][0].error and "no edition" in got[5][0].error
    found = {r.request: r for r in tools.lookup_entity(t, _asked(spark, [(1, "SET_CLOCK"), (2, "set_clok")], "request int, name string")).collect()}
    assert found[1].text.startswith("set_clock -period") and found[2].suggested == ["set_clock"]
    bad = {(r.name, r.option, r.problem) for r in tools.check_script(t, _asked(spark, [("s", "set_clock -per 1 -wrong 2\nnew_thing")], "request string, script string")).collect()}
    assert bad == {("set_clock", "-wrong", "unknown option"), ("new_thing", None, "unknown command")}
    assert tools.list_documents(t, _asked(spark, [(1, None)], "request int, collection string")).count() == 2
    toc = tools.get_toc(t, _asked(spark, [(1, "c", "g", None, None, None), (2, "c", "g-1", None, "1", "CLOCK")], "request int, collection string, document string, version string, max_level string, contains string")).collect()
    assert sorted((r.request, r.slug, r.title) for r in toc) == [(1, "g-2", "Clocks"), (1, "g-2", "Guide"), (2, "g-1", "Clocks"), (2, "g-1", "set_clock")]
    diff = tools.compare_versions(t, _asked(spark, [(1, "c", "g-1", "g-2", "set_clock")], "request int, collection string, old string, new string, name string")).collect()
    assert {(r.change, r.text) for r in diff} == {("removed", "Old words."), ("added", "New words.")}
    section = tools.get_section(t, _asked(spark, [(1, None, "1.md", None, None), (2, 99, None, None, None)], "request int, section_id long, file string, query string, context string")).collect()
    assert {(r.request, r.slug, r.error) for r in section} == {(1, "g-2", None), (2, None, "no such section")}
    log = tools.explain_log(t, _asked(spark, [(1, "Error: bad (ABC-12)\nWarning: odd (ABC-13)\nfine")], "request int, log string")).collect()
    assert [(r.code, r.missing) for r in sorted(log, key=lambda r: r.n)] == [("ABC-12", True), ("ABC-13", True)]


def test_entries_are_compared_as_readers_do(spark):
    key = compare.line_keys
    assert key("###### • **_setup_** the `data_*  x` “quoted” – dash") == key('- setup the `data_*  x` "quoted" - dash')
    assert key("set_mode -pattern data_*")[0] != key("set_mode -pattern data*")[0] and key("`a  b`")[0] != key("`a b`")[0] and key("`a  b`")[1] == key("`a b`")[1]
    old = "**One** line\nTwo lines\n```\nf( a )\n\nf(b)\n```\n---\nsame\nsame"
    new = "One  line\nTwo other lines\n```\nf(  a )\nf(b)\n```\nsame"
    df = lambda t: spark.createDataFrame([(1, t)], "k int, text string")
    got = sorted((r.change, r.text, r.other) for r in compare.entry_diff(df(old), df(new), ["k"]).collect())
    assert got == [("added", "Two other lines", None), ("removed", "Two lines", None), ("removed", "same", None), ("respaced", "f( a )", "f(  a )")]
