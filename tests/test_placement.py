"""Pages of chunks by their words, and chunks merged by lineage."""

import random
from collections import Counter

import oracle
from pyspark.sql import functions as F

from folioscan.operators import placement as P
from folioscan.plans import figures as Q


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(3, 9))) for _ in range(n))


def test_letters_and_own_words():
    assert P.letters("Ünïcode ﬁles, book-keeping: 2000!") == "unicodefilesbokeping20"
    assert P.own_words("*A > B*\nbody") == "body" and P.own_words("**Bold**\r\nbody") == "**Bold**\nbody"


def test_places_in_order_and_says_how_sure():
    a, b, c, d = (prose(k, 80) for k in range(4))
    pages = [f"Running title {a}", f"Running title {b[:250]}", f"Running title {b[250:]} {c}", f"Running title {d}"]
    got = P.placed([f"# Made up\n{a}", "stub", b, c, "no such words on any page at all here", d, "x"], pages)
    assert [(r.start, r.end, r.state) for r in got.itertuples()] == [(0, 0, "matched"), (1, 1, "neighbour"), (1, 2, "matched"), (2, 2, "matched"), (3, 3, "neighbour"), (3, 3, "matched"), (3, 3, "neighbour")]
    # Between two chunks on one page; an end that the pages don't have.
    tight = P.placed([a, "stub", c, f"{d[:300]} {prose(9, 200)}"], [f"{a} {c}", d, prose(10, 60)])
    assert [(r.start, r.end, r.state) for r in tight.itertuples()] == [(0, 0, "matched"), (0, 0, "bounded"), (0, 0, "matched"), (1, 2, "end-from-next")]
    assert P.placed(["words that are not there at all"], [a]).iloc[0].tolist() == [None, None, "unplaced"]
    assert P.placed([], [a]).empty


def test_a_far_match_needs_a_second_piece():
    a, far = prose(1, 80), prose(2, 80)
    gap = prose(3, 40_000)
    assert P.placed([a, far], [a, gap, far])["start"].tolist() == [0, 2]
    once = far[:40] + prose(4, 80)
    assert P.placed([a, once], [a, gap, far])["state"].tolist() == ["matched", "neighbour"]


def test_lines_of_documents_are_on_their_pages(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{oracle.SF}/documents.parquet").collect()}
    seen = Counter()
    for r in Q.chunk_page_placement(spark, oracle.SF).collect():
        lines = texts[r.doc_id].split("\n")
        at = sum(len(x) + 1 for x in lines[: r.ord])
        if r.state == "matched" and len(lines[r.ord]) >= 40:
            seen[(at // Q.PAGE_CHARS + 1, (at + len(lines[r.ord]) - 1) // Q.PAGE_CHARS + 1) == (r.page_start, r.page_end)] += 1
    # The rest begin or end at a page's edge with marks that are no letters.
    assert seen[True] > 1000 and seen[False] <= 0.005 * seen[True]


def test_placement_of_documents_without_pages_and_null_texts(spark):
    chunks = spark.createDataFrame([("a", 0, None), ("b", 0, "some words that are long enough"), ("b", 1, None)], "d string, ord int, text string")
    pages = spark.createDataFrame([("b", 7, "some words that are long enough"), ("b", 5, None), ("z", 1, "x")], "d string, page int, text string")
    rows = {(r.d, r.ord): (r.page_start, r.page_end, r.state) for r in P.page_placement(chunks, pages, ["d"]).collect()}
    assert rows == {("a", 0): (None, None, "unplaced"), ("b", 0): (7, 7, "matched"), ("b", 1): (7, 7, "neighbour")}
    assert P.page_placement(chunks.limit(0), pages, ["d"]).collect() == []


def test_lineages():
    assert P.shared_lineage(["a", "b"], ["a"]) == ["a"] and P.shared_lineage(["a", "b"], ["a", "c"]) == ["a"]
    assert P.shared_lineage([], ["a", "b"]) == [] and P.shared_lineage(["a"], ["b"]) == []
    assert P.shared_lineage(["a", "b", "c"], ["a", "x"]) is None and P.shared_lineage(["a", "b"], ["c", "d"]) is None


def test_merge_keeps_every_text_in_order(spark):
    S = "d string, ord int, heading string, text string, ancestors array<string>, confidence string, page_start int, page_end int"
    rows = [
        ("a", 0, "One", "t0", ["x", "y"], "anchored", 1, 1),
        ("a", 1, "One", "t1", ["x", "z"], "page", 1, 2),
        ("a", 2, "Two", "t2", ["x"], "anchored", 2, 3),
        ("a", 3, "Far", "t3", ["q", "r", "s"], "anchored", 4, 4),
        ("a", 4, None, None, None, "anchored", None, None),
        ("b", 0, "L", "v" * 90, ["x"], "anchored", 1, 1),
        ("b", 1, "L", "w" * 90, ["x"], "anchored", 1, 1),
    ]
    got = {(r.d, r.ord): r for r in P.merged_by_lineage(spark.createDataFrame(rows, S), ["d"], 200).collect()}
    one = got["a", 0]
    assert one.text == "t0\n\nt1\n\n### Two\n\nt2" and one.ancestors == ["x"] and one.confidence == "page" and (one.page_start, one.page_end, one.n) == (1, 3, 3)
    assert got["a", 3].text == "t3\n\n" and got["a", 3].ancestors == []  # no chain at all is the start of every chain
    assert got["b", 0].n == got["b", 1].n == 1 and len(got) == 4


def test_merged_conversations_lose_nothing(spark):
    c = spark.read.parquet(f"{oracle.SF}/conversations.parquet").groupBy("conv_id", "turn").agg(F.min("text").alias("text")).collect()
    rows = Q.lineage_merge(spark, oracle.SF).collect()
    assert sum(r.n for r in rows) == len(c)
    by = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.ord)):
        by[r.conv_id] = by.get(r.conv_id, "") + r.text
    for t in c:
        assert (t.text or "") in by[t.conv_id]
