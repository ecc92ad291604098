"""Figures, scopes, exclusions and reports: against plain walks over all pairs, and on fixtures."""

import re
from collections import defaultdict

import oracle

from folioscan.operators import catalog_tables, evaluate, figures
from folioscan.plans import figures as Q


def norm(text):
    return " ".join(re.findall(r"[0-9a-z]+", re.sub(r"<[^>]*>", " ", text or "").lower()))


def alike(a, b):
    short, long = sorted((a, b), key=len)
    return a == b or (len(short.split()) >= 4 and long.startswith(short + " "))


def walked(sections, figures_, paragraphs=True):
    """Every figure of one document against every line of every section."""
    lines = [(s["ord"], norm(x)) for s in sections for x in (s["text"] or "").splitlines() if not re.search(r"\.\s?\.\s?\.\s?\.", x)]
    lines = [(o, n) for o, n in lines if n.startswith(("figure ", "fig "))]
    paged, cursor, out = any(s["page_start"] is not None for s in sections), 0, {}
    for f in sorted(figures_, key=lambda f: f["figure"]):
        on = [s["ord"] for s in sections if None not in (s["page_start"], s["page_end"], f["page"]) and s["page_start"] <= f["page"] <= s["page_end"]]
        hits = sorted({o for o, n in lines if f["caption"] and norm(f["caption"]) and alike(norm(f["caption"]), n)})
        w = norm(f["context"]).split()
        has = [s["ord"] for s in sections if len(w) >= 5 and f" {' '.join(w[-8:])} " in f" {norm(s['text'])} "]
        ahead, near = [o for o in hits if o >= cursor], [o for o in has if cursor <= o < cursor + 6]
        far = [o for o in has if o not in near]
        caption = ahead[0] if ahead else hits[0] if len(hits) == 1 else None
        context = near[0] if near else far[0] if len(far) == 1 else None
        page = on[0] if len(on) == 1 else None
        link, section = next(((h, s) for h, s in (("caption", caption), ("page", page), ("context", context if paragraphs or not paged else None)) if s is not None), (None, None))
        cursor = cursor if section is None else section
        out[f["figure"]] = (section, link, page, context)
    return out


def test_links_are_those_of_a_walk_over_all_pairs(spark):
    sections, figs = Q.linked_inputs(spark, oracle.SF)
    found = {(r.lang, r.source, r.figure): (r.section, r.link, r.by_page, r.by_context) for r in Q.figure_links(spark, oracle.SF).collect()}
    by = defaultdict(lambda: ([], []))
    for k, rows in enumerate((sections, figs)):
        for r in rows.collect():
            by[r.lang, r.source][k].append(r.asDict())
    wanted = {(*d, f): v for d, (s, g) in by.items() for f, v in walked(sorted(s, key=lambda s: s["ord"]), g).items()}
    assert found == wanted
    assert {v[1] for v in wanted.values()} >= {"caption", "page", "context"}


def test_links_move_on_and_say_nothing_of_shared_pages(spark):
    S = "d string, ord long, text string, page_start int, page_end int"
    para = "the paragraph above a figure says what it is about in full"
    sections = [("a", 0, "intro", 1, 2), ("a", 1, "**Figure 1. Open clock tree view<br>**\nx", 2, 3), ("a", 2, f"{para}.", 4, 4), ("a", 3, f"Figure 1. Open clock tree view\n{para}", 5, 5), ("a", 4, "Figure 9. Row . . . . 7", None, None), ("b", 0, None, None, None)]
    figs = [("a", 0, 2, None, ""), ("a", 1, 3, "Figure 1: Open Clock Tree View", ""), ("a", 2, 9, "", para), ("a", 3, 9, "Figure 1 Open clock tree", para), ("a", 4, None, "Figure 9. Row", None), ("b", 0, 1, "Figure 1", para), ("c", 0, 1, None, None)]
    F_ = "d string, figure long, page int, caption string, context string"
    rows = figures.links(spark.createDataFrame(sections, S), spark.createDataFrame(figs, F_), ["d"])
    got = {(r.d, r.figure): (r.section, r.link) for r in rows.collect()}
    none = (None, None)
    assert got == {("a", 0): none, ("a", 1): (1, "caption"), ("a", 2): (2, "context"), ("a", 3): (3, "caption"), ("a", 4): none, ("b", 0): none, ("c", 0): none}
    # Where sections have pages, paragraphs can be left out.
    without = figures.links(spark.createDataFrame(sections, S), spark.createDataFrame(figs, F_), ["d"], paragraphs=False)
    assert {r.figure: r.link for r in without.filter("d = 'a'").collect()}[2] is None
    a = figures.agreement(rows, ["d"]).filter("d = 'a'").first()
    assert (a.figures, a.link_caption, a.link_page, a.link_context, a.link_none, a.page_agree, a.context_agree, a.context_disagree) == (5, 2, 0, 1, 2, 1, 0, 1)
    assert figures.links(spark.createDataFrame([], S), spark.createDataFrame([], F_), ["d"]).collect() == []


def assigned(boxes):
    """The rule of captions over one page's boxes, as a plain double loop."""
    pics = [b for b in boxes if b["kind"] == "picture" and min(b["x1"] - b["x0"], b["y1"] - b["y0"]) >= 36 and (b["x1"] - b["x0"]) * (b["y1"] - b["y0"]) >= 4000]
    texts = [b for b in boxes if b["kind"] in figures.TEXT_BOXES and b["lines"]]
    over = lambda p, t: min(p["x1"], t["x1"]) > max(p["x0"], t["x0"])
    pairs = []
    for p in pics:
        for t in texts:
            first = t["lines"][0]
            if not over(p, t) or not re.match(r"\s*(figure|fig\.)\s*[A-Z]?[\d.-]*\d", first, re.I) or re.match(r"\s*(?i:figure|fig\.)\s*[A-Z]?[\d.-]*\d\s+[a-z]", first):
                continue
            gap = p["y0"] - t["y1"] if t["y1"] <= p["y0"] + 2 else t["y0"] - p["y1"] if t["y0"] >= p["y1"] - 2 else None
            if gap is not None and gap <= 90:
                pairs.append((t["kind"] != "caption", gap, p["box"], t["box"]))
    of = {}
    for _, _, p, t in sorted(pairs):
        if p not in of and t not in of.values():
            of[p] = t
    out = {}
    for p in pics:
        above = [t for t in texts if t["box"] not in of.values() and over(p, t) and t["y1"] <= p["y0"] + 2]
        best = max(above, key=lambda t: (t["y1"], -t["box"]), default=None)
        out[p["box"]] = (of.get(p["box"]), " ".join(best["lines"]) if best else "")
    return out


def test_captions_go_to_the_nearest_figure(spark):
    by = defaultdict(list)
    for r in Q.page_boxes(spark, oracle.SF).collect():
        by[r.page].append(r.asDict())
    found = {(r.page, r.box): (r.caption, r.context) for r in Q.caption_assignment(spark, oracle.SF).collect()}
    wanted = {}
    for page, boxes in by.items():
        lines = {b["box"]: (b["lines"], b["kind"]) for b in boxes}
        for box, (t, context) in assigned(boxes).items():
            own = "" if t is None else " ".join(lines[t][0]) if lines[t][1] == "caption" else lines[t][0][0]
            wanted[page, box] = (own, context)
    assert found == wanted and any(c for c, _ in wanted.values()) and any(c for _, c in wanted.values())


def test_readings_carry_over_only_for_the_same_art(spark):
    S = "d string, id string, bbox array<double>, fingerprint string, file string, ocr string"
    old = spark.createDataFrame([("a", "p1", [1.0], "f", "1.png", "one"), ("a", "p2", [1.0], None, "2.png", "two"), ("a", "p3", [1.0], "f", "3.png", "three"), ("a", "p4", [1.0], "f", "4.png", "four"), ("b", "p1", [1.0], "f", "1.png", "else")], S)
    new = spark.createDataFrame([("a", "p1", [1.0], "f", "1.png", None), ("a", "p2", [1.0], "g", "2.png", None), ("a", "p3", [1.0], None, "3.png", None), ("a", "p5", [2.0], "f", "5.png", None)], S)
    assert {r.id: r.ocr for r in figures.carried(new, old, ["d"]).collect()} == {"p1": "one", "p2": "two", "p3": None, "p5": None}
    assert [(r.d, r.file) for r in figures.stale_files(old, new, ["d"]).collect()] == [("a", "4.png")]


def test_answered_sections_are_left_out(spark):
    s = spark.createDataFrame([("x", "m", "1"), ("y", "m", "1"), ("x", "m", "2"), ("y", "m", "2"), ("x", "n", "1"), (None, "n", "3")], "collection string, slug string, file string")
    a = spark.createDataFrame([("x", "m", "1"), (None, "m", "2"), ("x", "n", None), (None, None, None)], "collection string, slug string, file string")
    assert sorted((r.collection or "", r.slug, r.file) for r in evaluate.unanswered(s, a).collect()) == [("", "n", "3"), ("x", "n", "1"), ("y", "m", "1")]


def test_scopes_never_guess(spark):
    docs = spark.createDataFrame([("c", "m", "m-1", "2023.1", False), ("c", "m", "m-2", "2024.1", False)], "collection string, doc_id string, slug string, version string, version_later boolean")
    q = spark.createDataFrame([(1, "c", None, None), (2, "c", "m", None), (3, "c", "m", "2023.1"), (4, "c", "m", "2022.1"), (5, "c", None, "2023.1"), (6, "c", "z", None)], "id long, collection string, document string, version string")
    rows = {r.id: (r.scope_slug, r.scope_error) for r in evaluate.scopes(q, docs).collect()}
    assert rows[1] == (None, None) and rows[2] == ("m-2", None) and rows[3] == ("m-1", None)
    assert rows[4][0] is None and rows[4][1] and "needs" in rows[5][1] and rows[6] == (None, "no edition")


def test_report_keeps_long_values_whole(spark):
    rows = spark.createDataFrame([(0, "a", 5), (1, "much longer", None)], "k long, name string, n long")
    lines = [r.line for r in catalog_tables.report_lines(rows, {"name": 4, "n": 3}, "k", ["n"]).orderBy("n").collect()]
    assert lines == ["a       5", "much longer    -", "total    5"]
