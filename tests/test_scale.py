"""What decides how a query grows: no call for every small group, no pairs where counts do, the same rows as by the plain rule."""

import random
import re
import time

import numpy as np
import oracle
import pyarrow as pa
from pyspark.sql import functions as F

from folioscan.operators import compare as C
from folioscan.operators import figures as G
from folioscan.operators import index as I
from folioscan.operators import lookup as L
from folioscan.operators import outline as O
from folioscan.operators import passages as P
from folioscan.operators import search as S
from folioscan.plans import figures as FQ


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_captions_make_no_call_for_every_page(spark):
    assert "Pandas" not in plan(FQ.caption_assignment(spark, oracle.SF))
    S = "page int, box int, kind string, x0 double, y0 double, x1 double, y1 double, lines array<string>"
    pic = lambda b, y: (1, b, "picture", 0.0, y, 100.0, y + 100, None)
    rows = [pic(1, 50.0), pic(2, 200.0), (1, 3, "text", 0.0, 152.0, 90.0, 160.0, ["Fig. 1. One"]), (1, 4, "caption", 0.0, 180.0, 90.0, 190.0, ["Fig. 2. Two"]), (1, 5, "text", 0.0, 10.0, 90.0, 20.0, ["above"])]
    got = {r.box: (r.caption, r.context) for r in G.captions_of(spark.createDataFrame(rows, S), ["page"]).collect()}
    # The caption box goes to the nearer picture before the plain text finds its own.
    assert got == {1: ("Fig. 1. One", "above"), 2: ("Fig. 2. Two", "above")}


def test_placement_makes_no_call_for_every_document(spark):
    assert "InPandas" not in plan(FQ.chunk_page_placement(spark, oracle.SF))


def test_batches_become_python_objects_in_bounded_pieces():
    batch = pa.RecordBatch.from_pydict({"n": list(range(400)), "text": ["x" * (50_000 if n % 7 == 0 else 100) for n in range(400)]})
    own = list(P.pieces(batch))
    assert [v for b in own for v in b.column("n").to_pylist()] == list(range(400))
    assert all(b.nbytes <= P.PIECE for b in own) and len(own) > 2
    long = pa.RecordBatch.from_pydict({"text": ["y" * (3 * P.PIECE)] * 2})
    assert [b.num_rows for b in P.pieces(long)] == [1, 1]


def test_phrases_of_a_long_text_take_no_time_in_its_square(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    docs = spark.createDataFrame([(1, long), (2, "w7 w8 w9"), (3, None)], "doc long, text string")
    asked = spark.createDataFrame([(1, '"w7 w8 w9"'), (2, '"w7 w8 w99*"'), (3, '"w59998 w59*"'), (4, "w5999*"), (5, "w9_w7 w8")], "qid long, query string")
    began = time.time()
    got = {(r.qid, r.doc, r.n_hit, r.n_terms) for r in S.phrase_matches(asked, docs, ["doc"], "text").collect()}
    assert got == {(1, 1, 1, 1), (1, 2, 1, 1), (3, 1, 1, 1), (4, 1, 1, 1), (5, 1, 1, 2), (5, 2, 1, 2)}
    assert time.time() - began < 20


def test_quotes_of_a_long_text_take_no_time_in_its_square(spark):
    words = [f"w{k % 7}" if k % 2 else f"u{k}" for k in range(120_000)]
    asked = spark.createDataFrame([(k, f"x w{k} u{1_000 + 14 * k} w{k} y") for k in range(7)] + [(9, " ".join(words[2_000:2_009]))], "q long, text string")
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "u1 w2")], "doc long, text string")
    began = time.time()
    assert [(r.q, r.doc) for r in C.quotes(asked, docs, "q", "doc").collect()] == [(9, 1)]
    assert time.time() - began < 20


def test_matches_in_order_are_those_of_all_pairs():
    rng = random.Random(3)
    for k in range(400):
        keys = "abcdef"[: rng.randint(1, 6)]
        entries = {c: np.array(sorted(rng.sample(range(60), rng.randint(1, 25)))) for c in keys}
        lines = [(at, rng.choice(keys + "z"), rng.random() < 0.3) for at in range(rng.randint(0, 60))]
        pairs = [(at, int(e), opens) for at, c, opens in lines for e in reversed(entries.get(c, []))]
        assert O.longest_of_keys(lines, entries) == O.longest_in_order(pairs), k


def test_matches_in_order_of_a_title_that_repeats_make_no_pairs(spark, monkeypatch):
    n = 6_000
    toc = spark.range(n).select(F.lit(1).alias("d"), F.col("id").alias("idx"), F.lit(1).alias("level"), F.lit("Overview").alias("title"), F.col("id").alias("page"))
    chunks = toc.select("d", F.col("idx").alias("ord"), F.lit("Manual").alias("title"), F.lit("# Overview").alias("body"))
    monkeypatch.setattr(O, "in_order", lambda *a: 1 / 0)
    assert O.breadcrumbs(chunks, toc, ["d"]).count() == n
    lines, entries = [(k, "a" if k % 3 else "b", True) for k in range(20_000)], {c: np.arange(c == "b", 20_000, 2) for c in "ab"}
    began = time.time()
    assert len(O.longest_of_keys(lines, entries)) > 9_000 and time.time() - began < 60


DOCS = [(1, "s", "a b a c"), (2, "s", "b b"), (2, "s", "b b"), (3, None, None), (4, "t", "a d")]


def test_postings_move_once(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, source string, text string")
    made = I.postings(docs, ["doc_id", "source"], {"text": 1.0})
    p = plan(made["postings"])
    assert p.count("Exchange") == 2 and "rangepartitioning" not in p and not re.search(r"hashpartitioning\([^)]*n_tokens", p)
    # Rows of one document are one document, as in SQL.
    assert {(r.doc_id, r.term): (r.n_tokens, r.f) for r in made["postings"].collect()} == {(1, "a"): (4, 2.0), (1, "b"): (4, 1.0), (1, "c"): (4, 1.0), (2, "b"): (2, 4.0), (4, "a"): (2, 1.0), (4, "d"): (2, 1.0)}


def test_pairs_of_queries_and_documents_are_not_shuffled(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, source string, text string")
    asked = spark.createDataFrame([(1, ["a", "b"]), (2, ["d"])], "qid long, terms array<string>")
    scored = S.bm25(asked, docs, ["doc_id", "source"], {"text": 1.0})
    assert not re.search(r"hashpartitioning\(qid[^)]*doc_id", plan(scored))
    modes = S.all_else_any(scored, 1)
    assert "Window" not in plan(modes)
    assert {(r.qid, r.doc_id, r.n_hit, r.mode) for r in modes.collect()} == {(1, 1, 2, "all"), (2, 4, 1, "all")}
    assert {(r.qid, r.doc_id, r.mode) for r in S.all_else_any(scored, 2).collect()} == {(1, 1, "any"), (1, 2, "any"), (1, 4, "any"), (2, 4, "any")}


def test_figures_that_share_a_caption_share_its_sections(spark):
    text = "Figure 1. Open clock tree view\nthe paragraph above a figure says what it is about"
    sections = spark.range(30).select(F.lit("a").alias("d"), F.col("id").alias("ord"), F.lit(text).alias("text"))
    figs = spark.range(40).select(F.lit("a").alias("d"), F.col("id").alias("figure"), F.lit("Figure 1: open clock tree view").alias("caption"), F.lit("the paragraph above a figure says what it is about").alias("context"))
    assert [len(r.ords) for hits in (G._caption_hits, G._context_hits) for r in hits(sections, figs, ["d"]).collect()] == [30, 30]


def test_snippets_weigh_only_windows_that_end_in_a_hit(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("abcdefgh") + rng.choice(["", "", "x"]) for _ in range(rng.randint(1, 70))), rng.sample("abcz", rng.randint(0, 3))) for k in range(150)]
    got = {r.k: r.snippet for r in S.snippets(spark.createDataFrame(rows, "k long, body string, terms array<string>"), size=9).collect()}
    for k, body, terms in rows:
        w = body.split(" ")
        at = max(range(max(len(w) - 9, 0) + 1), key=lambda i: (len(set(w[i : i + 9]) & set(terms)), -i))
        shown = " ".join(f"[{x}]" if x in terms else x for x in w[at : at + 9])
        assert got[k] == ("…" if at else "") + shown + ("…" if at + 9 < len(w) else "")
    p = S.snippets(spark.createDataFrame(rows, "k long, body string, terms array<string>"))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("filter(sequence(0") >= 1


def test_entries_are_met_once_without_telling_all_hits_apart(spark):
    own = spark.createDataFrame([("d", "Rule A1", 3), ("d", "a1", 4), ("e", "A1", 5), ("e", "A1", 6)], "slug string, entity string, page int").selectExpr("slug", "entity", "page page_start", "page page_end")
    asked = spark.createDataFrame([(1, "rule a1"), (1, "rule a1"), (1, "drc rule A1"), (2, "x"), (3, None)], "qid long, name string")
    found = L.lookup(asked, L.entities(own, ["slug"]), ["slug"])
    made = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert [line for line in made if re.search(r"Aggregate \[qid", line)] and not [line for line in made if re.search(r"Aggregate \[qid#\d+L?, slug", line)]
    got = sorted((r.qid, r.name or "", r.slug or "", r.entity or "", r.chunk_count or 0) for r in found.collect())
    hits = [("d", "Rule A1", 1), ("d", "a1", 1), ("e", "A1", 2)]
    assert got == sorted([*((1, n, *h) for n in ("rule a1", "rule a1", "drc rule A1") for h in hits), (2, "x", "", "", 0), (3, "", "", "", 0)])
