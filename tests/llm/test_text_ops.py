"""Operators 2, 3, 4, 10: leaks, quality scores and rules, licences."""

import random
import re

from util import ODD, documents, prose

from folioscan.llm import op2_leaks, op3_quality, op4_rules, op10_licenses

ITEMS = "item_id long, text string"


def _items():
    return [(k, prose(900 + k, 60).replace("\n", " ")) for k in range(8)] + [(98, None), (99, "")]


def test_leaks_exact_and_edited(spark):
    items = _items()
    words = items[3][1].split()
    edited = [w if k % 9 else "changed" for k, w in enumerate(words)]
    short = words[:20] + words[24:]
    texts = [prose(1, 200), prose(2, 50) + " " + items[0][1] + " " + prose(3, 50), items[1][1].upper(), " ".join(edited), prose(4, 30) + " " + " ".join(short), *ODD]
    docs = documents(spark, texts, extra=True)
    found = {(r.doc_id, r.item_id): r for r in op2_leaks.leaks(spark, docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert set(found) == {(1, 0), (2, 1), (3, 3), (4, 3)}
    assert found[1, 0].similarity == 1.0 and found[2, 1].similarity == 1.0
    assert 0.5 < found[3, 3].similarity < 1 and found[1, 0].end_word - found[1, 0].start_word == len(op2_leaks.words_of(items[0][1]))
    kept = {r.doc_id for r in op2_leaks.without_leaks(spark, docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert kept == set(range(len(texts))) - {1, 2, 3, 4}


def test_leaks_that_are_everywhere_and_empty_tables(spark):
    items = spark.createDataFrame(_items(), ITEMS)
    text = _items()[5][1]
    docs = documents(spark, [text + f" {k}" for k in range(60)])
    assert op2_leaks.leaks(spark, docs, items).count() == 60
    assert op2_leaks.leaks(spark, documents(spark, []), items).count() == 0
    assert op2_leaks.leaks(spark, docs, spark.createDataFrame([], ITEMS)).count() == 0
    assert op2_leaks.without_leaks(spark, docs, spark.createDataFrame([], ITEMS)).count() == 60


def test_local_alignment_is_smith_waterman():
    import random

    import numpy as np

    def brute(a, b):
        best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] and a[i - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
                best = max(best, h[i][j])
        return best

    rng = random.Random(3)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 25))] for _ in range(2))
        score, lo, hi = op2_leaks.align(np.array(a), np.array(b))
        assert score == brute(a, b)
        if score:
            assert brute(a[lo:hi], b) == score


def test_quality_scores_learn_and_hold_out(spark):
    good = [prose(k, 150) for k in range(60)]
    bad = ["buy now cheap click here!!! " * (8 + k % 5) + str(k) for k in range(60)]
    texts = good + bad + ODD
    docs = documents(spark, texts, extra=True)
    labels = spark.createDataFrame([(k, int(k < 60), 0) for k in range(120)] + [(3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in op3_quality.classify(spark, docs, labels).collect()}
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    held = [i for i in range(120) if rows[i].held_out]
    assert held and sum(rows[i].predicted == (i < 60) for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values()) and len(rows) == len(texts)
    learnable = [i for i in range(120) if not rows[i].held_out]
    rate = sum(i < 60 for i in learnable) / len(learnable)
    assert abs(rows[120].score - rate) < 1e-9 and abs(rows[121].score - rate) < 1e-9  # null and empty
    null = op3_quality.classify(spark, documents(spark, [good[0], None], ids=[None, 7]), labels).collect()
    assert [(r.doc_id, r.held_out) for r in null] == [(None, False), (7, False)]


def test_the_fit_is_bounded_in_bytes(spark):
    docs = documents(spark, [prose(k, 100) for k in range(40)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    assert isinstance(op3_quality.fit(docs, labels, most_bytes=4000), op3_quality.Model)
    assert isinstance(op3_quality.fit(docs, labels, most_bytes=100), op3_quality.Constant)


def test_quality_scores_keep_the_base_rate_where_the_bound_bites(spark):
    # Texts say nothing about their labels, of which 4 in 5 are 1: calibrated scores of texts not learnt from are about 0.8, whatever the bound.
    docs = documents(spark, [prose(k, 60) for k in range(800)]).cache()
    labels = spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(800)], "doc_id long, quality int")
    for most in (100, 800):
        scores = [r.score for r in op3_quality.classify(spark, docs, labels, most).filter("held_out").collect()]
        assert 0.7 < sum(scores) / len(scores) < 0.9


def test_quality_scores_without_labels(spark):
    docs = documents(spark, ["a", None])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in op3_quality.classify(spark, docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    assert {r.score for r in op3_quality.classify(spark, documents(spark, ["a", "b"]), one).collect()} <= {1.0, 0.5}
    assert op3_quality.classify(spark, documents(spark, []), one).count() == 0


def brute4(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup, at, covered = set(), 0, {}, set()
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    for v in at.values():
        if len(v) > 1:
            covered |= {i + k for i in v for k in range(5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_rule_statistics_are_brute_force(spark):
    texts = ["fish of fluff", "f", "\fend of f\f", "a\n\na\n a\na", "### $$ | <b>", "one two three four five six " * 9, "é ü x \U0001f600 z", *[prose(k, 40 + 20 * k) for k in range(30)], *ODD]
    docs = documents(spark, texts, extra=True)
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in op4_rules.judged(spark, docs).collect()}
    assert got == {i: brute4(t) for i, t in enumerate(texts)}


def test_rules_reject_outliers_and_keep_the_rest(spark):
    texts = [prose(k, 120) for k in range(150)] + ["### $$$ %%% &&& ||| " * 20 + " ".join(f"w{k}{j}" for j in range(200)) for k in range(3)]
    docs = documents(spark, texts)
    rows = {r.doc_id: r for r in op4_rules.judged(spark, docs).collect()}
    assert all(rows[i].kept for i in range(150)) and not any(rows[i].kept for i in range(150, 153))
    kept = op4_rules.keep_good(spark, docs)
    assert kept.columns == docs.columns and kept.count() == 150
    assert op4_rules.judged(spark, documents(spark, [])).count() == 0


def test_distances_are_those_of_the_estimate_of_least_determinant(spark):
    import math

    import numpy as np

    rng = random.Random(6)
    texts = []
    for k in range(160):
        words = prose(k, rng.randrange(60, 160)).split()
        texts.append(" ".join(w.capitalize() if rng.random() < 0.1 * (k % 4) else w for w in words) + " %" * rng.randrange(5 if k % 5 else 40))
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    rows = sorted(op4_rules.judged(spark, docs).collect(), key=lambda r: r.doc_id)
    x = []
    for t in texts:
        n, chars, symbols, dup, repeated, _ = brute4(t)
        upper = sum(c.isupper() for c in t)
        x.append([math.log(chars / n), math.log1p(100 * symbols / n), math.log1p(100 * upper / chars), math.log1p(100 * repeated / n + dup)])
    x, floor = np.round(np.array(x), 6), np.diag(np.square(op4_rules.FLOOR))

    def estimate(h):
        m = x[h].mean(0)
        return m, op4_rules.CONSISTENT * (x[h] - m).T @ (x[h] - m) / len(h) + floor

    best = None
    for _ in range(40):  # concentration from random starts
        m, s = estimate(rng.sample(range(160), 5))
        for _ in range(30):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(s), x - m)
            m, s = estimate(np.argsort(d, kind="stable")[:120])
        if best is None or np.linalg.slogdet(s)[1] < best[0]:
            best = (np.linalg.slogdet(s)[1], m, s)
    d = np.einsum("ij,jk,ik->i", x - best[1], np.linalg.inv(best[2]), x - best[1])
    got = np.array([r.distance for r in rows])
    assert np.abs(got - d).max() <= 0.05 * (1 + d.max())
    assert [r.kept for r in rows] == [bool(v <= op4_rules.CUTOFF) and not r.base_failed for v, r in zip(got, rows, strict=True)]


def test_rules_judge_each_row_of_a_repeated_id(spark):
    good = [prose(k, 100) for k in range(60)]
    docs = documents(spark, [*good, "few words", good[1], None], ids=[*range(60), 5, 1, None]).selectExpr("*", "1 AS _kept_id", "2 AS k", "3 AS `row`", "4 AS digest")
    out = op4_rules.keep_good(spark, docs)
    assert out.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in out.collect()]
    assert (5, "few words") not in rows and (5, good[5]) in rows and rows.count((1, good[1])) == 2 and len(rows) == 61


def test_rules_meet_large_numbers_of_groups_in_salted_parts(spark, monkeypatch):
    docs = documents(spark, [prose(k, 80) for k in range(70)])
    want = {tuple(r) for r in op4_rules.judged(spark, docs).collect()}
    monkeypatch.setattr(op4_rules, "BROADCAST_GROUPS", 0)
    assert {tuple(r) for r in op4_rules.judged(spark, docs).collect()} == want


def test_rules_take_nulls_and_repeated_rows(spark):
    rows = [(1, prose(1, 50), None, None, None)] * 2 + [(None, None, "en", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert op4_rules.judged(spark, docs).count() == 3
    assert op4_rules.keep_good(spark, docs).count() == 2


def test_no_python_in_native_plans(spark):
    for df in (op4_rules.judged(spark, documents(spark, [prose(1, 50)])), op10_licenses.scan(spark, spark.createDataFrame([("a/b", "x", False)], "path string, text string, named boolean"))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_licenses_are_inherited_from_the_nearest_directory(spark):
    mit = "Released under the MIT License"
    apache = "Licensed under the Apache License, Version 2.0"
    files = [("r/LICENSE", mit, True), ("r/a.c", "int x;", False), ("r/sub/deep/b.c", "int y;", False), ("r/sub/LICENSE", apache, True), ("r/own.c", f"int z;\n{apache}\nmore code here " * 3, False), ("q/c.c", None, False), ("q/d.c", "", False), ("top", "hello", False)]
    df = spark.createDataFrame(files, "path string, text string, named boolean")
    got = {r.path: (r.license, r.found, r.inherited_from) for r in op10_licenses.scan(spark, df).collect()}
    assert got["r/LICENSE"] == ("MIT", "own", None) and got["r/a.c"] == ("MIT", "inherited", "r/LICENSE")
    assert got["r/sub/deep/b.c"] == ("Apache-2.0", "inherited", "r/sub/LICENSE") and got["r/own.c"][:2] == ("Apache-2.0", "own")
    assert got["q/c.c"] == got["q/d.c"] == got["top"] == (None, "none", None)
    assert op10_licenses.scan(spark, df.limit(0)).count() == 0


def brute10(text, cosine=0.7):
    """(licence, score) by every window of every notice, and the whole text against every whole text."""
    import math
    from collections import Counter

    own = op10_licenses.Templates()
    tokens = op10_licenses.tokens_of(text or "")

    def cos(x, template):
        a = {t: n * own.idf.get(t, own.unknown) for t, n in Counter(x).items()}
        b = {t: n * own.idf[t] for t, n in template.items()}
        dot = sum(v * b.get(t, 0) for t, v in a.items())
        return round(dot / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values())), 6) if x else 0.0

    found = []
    for (kind, name, k), template in own.counts.items():
        n = template.total()
        windows = [tokens] if kind == "text" else [tokens[i : i + n] for i in range(max(1, len(tokens) - n + 1))]
        best = max(cos(w, template) for w in windows)
        if best >= cosine:
            found.append((kind == "notice", -best, -n if kind == "notice" else 0, name))
    if not found:
        return None, None
    _, score, _, name = min(found)
    return name, -score


def test_licenses_are_brute_force(spark):
    rng = random.Random(10)
    texts = [prose(k, 60) for k in range(6)]
    every = [t for some in op10_licenses.NOTICES.values() for t in some] + list(op10_licenses.TEXTS.values())
    for t in every:
        words = t.split()
        texts.append(t if rng.random() < 0.3 else " ".join(w for w in words if rng.random() < 0.85))
        texts.append(prose(rng.randrange(999), 20) + " " + " ".join("other" if rng.random() < 0.2 else w for w in words) + "\n" + prose(rng.randrange(999), 9))
    texts += ["license " * 300, "mit mit license the the", "released under the terms of nothing", *ODD]
    files = spark.createDataFrame([(f"{k}/f", t, False, "x") for k, t in enumerate(texts)], "path string, text string, named boolean, license string")
    got = {r.path: (r.license, r.score) for r in op10_licenses.scan(spark, files).collect()}
    wrong = []
    for k, t in enumerate(texts):
        name, score = brute10(t)
        mine = got[f"{k}/f"]
        if mine[0] != name and not (mine[1] is not None and score is not None and abs(mine[1] - score) < 2e-6) or (score is not None and abs(mine[1] - score) > 2e-6):
            wrong.append((k, mine, name, score, t[:80] if t else t))
    assert wrong == []


def test_license_texts_versions_and_ties(spark):
    t = op10_licenses.TEXTS
    want = {
        "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\nCopyright (C) 1989 Free Software Foundation, Inc.": "GPL-2.0",
        "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "GPL-3.0",
        "Apache License\nVersion 2.0,\nJanuary 2004": "Apache-2.0",
        "SPDX-License-Identifier: BSD-2-Clause": "BSD-2-Clause",
        **{text.replace("(c).", "(c) 2020 Jane Doe.").replace(" ", "\n", 9): name for name, text in t.items()},
        prose(3, 300) + t["BSD-3-Clause"] + prose(4, 300): "BSD-3-Clause",
    }
    files = spark.createDataFrame([(f"{k}/f", text, False) for k, text in enumerate(want)], "path string, text string, named boolean")
    got = {r.path: r.license for r in op10_licenses.scan(spark, files).collect()}
    assert [got[f"{k}/f"] for k in range(len(want))] == list(want.values())
    rows = [("a/LICENSE", "MIT License", None), ("a/LICENSE", "nothing here", False), ("a/COPYING", "ISC License", True), ("a/x", None, None), (None, "MIT License", True), ("b/x", "word " * 50_000 + "MIT License", False)]
    files = spark.createDataFrame([(*r, "k", 1, "n") for r in rows], "path string, text string, named boolean, dir string, depth int, own string")
    got = [(r.path, r.license, r.found, r.inherited_from) for r in op10_licenses.scan(spark, files, keep=("dir",)).collect()]
    assert sorted(got, key=str) == sorted([("a/LICENSE", "MIT", "own", None)] * 2 + [("a/COPYING", "ISC", "own", None), ("a/x", "ISC", "inherited", "a/COPYING"), (None, None, "none", None), ("b/x", "MIT", "own", None)], key=str)


def test_licenses_inside_prose_headers_and_wrapped_lines(spark):
    gpl = "This program is free software; you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation; either version {} of the License, or later."
    prose_ = "Rain fell on the roofs of the town and nobody went out that day. " * 20
    want = {
        "Copyright 2020 Jane Doe. Licensed under the MIT License.": "MIT",
        "The text of this page is licensed under CC BY 4.0 unless noted otherwise.": "CC-BY-4.0",
        "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "This project is released under the MIT License, see LICENSE.txt for details.": "MIT",
        prose_ + "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License. " + prose_: "CC-BY-SA-4.0",
        "# tool.py\n# " + gpl.format(2): "GPL-2.0",
        "# tool.py\n# " + gpl.format(3): "GPL-3.0",
        "We use the GNU Lesser General Public License version 3 here": "LGPL-3.0",
        "Her driving license and the copyright of her poems were lost": None,
        "The licence to sell fish is given by the town": None,
    }
    files = spark.createDataFrame([(f"{k}/f", t, False) for k, t in enumerate(want)], "path string, text string, named boolean")
    got = {r.path: r.license for r in op10_licenses.scan(spark, files).collect()}
    assert [got[f"{k}/f"] for k in range(len(want))] == list(want.values())
