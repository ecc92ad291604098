"""What waits and why, on a fixture with every reason."""

from folioscan.operators import intake

W = "collection string, file string, readable boolean, verdict string, picked int, level int, title string, slug string, doc_id string, version string, digest string"
D = "key string, shape string, title string, command_level int, converter string, version string, doc_id string"
X = "collection string, slug string, doc_id string, converter string"


def waits(file, verdict="reference", picked=2, level=2, title="T", slug=None, doc_id=None, version="2023.1", digest=None, collection="c", readable=True):
    return (collection, file, readable, verdict, picked, level, title, slug or file, doc_id or file, version, digest or f"{collection}/{file}")


def decides(key, **own):
    return (key, *[own.get(c) for c in ("shape", "title", "command_level", "converter", "version", "doc_id")])


def planned(spark, waiting, decisions=(), filed=(), **more):
    rows = intake.plans(spark.createDataFrame(list(waiting), W), spark.createDataFrame(list(decisions), D), spark.createDataFrame(list(filed), X), **more).collect()
    assert len(rows) == len(waiting)
    return {(r.collection, r.file) if r.collection != "c" else r.file: r for r in rows}


def test_each_file_says_what_it_lacks(spark):
    rows = planned(
        spark,
        [waits("a"), waits("b", readable=False, verdict=None, title=None, picked=None), waits("c", "no-text"), waits("d", "no-toc"), waits("e", "mixed", title=None), waits("f", picked=1), waits("g", slug="old"), waits("h", "prose"), waits("i", "mixed")],
        [decides("i", shape="reference", command_level=3, title=" New ")],
        [("c", "old", "m", "convert_manual")],
    )
    assert {k: r.held for k, r in rows.items()} == {"a": [], "b": ["unreadable"], "c": ["no-text"], "d": ["no-outline"], "e": ["mixed-shape", "no-title"], "f": ["level-unsure"], "g": ["already-filed"], "h": ["no-converter"], "i": []}
    assert rows["a"].converter == rows["i"].converter == "convert_manual" and rows["i"].title == "New" and rows["h"].converter is None


def test_prose_takes_the_converter_of_its_other_editions(spark):
    filed = [("c", "x1", "x", "convert_manual"), ("c", "y1", "y", "convert_manual"), ("c", "y2", "y", "convert_docling"), ("c", "z1", "z", None)]
    waiting = [waits(k, "prose", doc_id=k) for k in "xyzw"]
    rows = planned(spark, waiting, [decides("c/w", converter="convert_manual")], filed, layout=True)
    assert {k: r.converter for k, r in rows.items()} == {"x": "convert_manual", "y": "convert_docling", "z": "convert_docling", "w": "convert_manual"}
    rows = planned(spark, waiting, [decides("c/w", converter="convert_docling")], filed)
    assert {k: (r.converter, r.held) for k, r in rows.items()} == {"x": ("convert_manual", []), "y": (None, ["no-converter"]), "z": (None, ["no-converter"]), "w": (None, ["no-converter"])}


def test_files_that_wait_together(spark):
    rows = planned(
        spark,
        [
            waits("a1", doc_id="m"), waits("a2", doc_id="m", version=None), waits("a3", doc_id="m", version="2023.01"), waits("a4", doc_id="m", version="2024.1"),
            waits("b1", slug="s"), waits("b2", slug="s"), waits("d1", digest="same"), waits("d2", digest="same"),
            waits("e1", doc_id="n", readable=False), waits("e2", doc_id="n"), waits("e3", doc_id="o", version=None),
        ],
    )
    held = {k: r.held for k, r in rows.items()}
    assert held["a1"] == [] and held["a2"] == ["no-version-to-order"] and held["a3"] == ["same-release-waits"] and held["a4"] == []
    assert held["b1"] == [] and held["b2"] == ["slug-waits"] and held["d1"] == [] and held["d2"] == ["byte-twin-waits"]
    # One that can't be converted stands in nobody's way; one alone needs no version.
    assert held["e1"] == ["unreadable"] and held["e2"] == [] and held["e3"] == []


def test_decisions_by_name_alone(spark):
    waiting = [waits("a"), waits("a", collection="k"), waits("b")]
    decisions = [decides("a", title="Both"), decides("k/a", title="K"), decides("b", title="B"), decides("c/zzz"), decides("zzz")]
    rows = planned(spark, waiting, decisions)
    assert rows["a"].held == ["ambiguous-decision"] and rows["a"].title == "T" and rows["k", "a"].title == "K" and rows["k", "a"].held == [] and rows["b"].title == "B"
    left = intake.unused_decisions(spark.createDataFrame(waiting, W), spark.createDataFrame(decisions, D))
    assert {r.key for r in left.collect()} == {"c/zzz", "zzz"}
    assert intake.plans(spark.createDataFrame([], W), spark.createDataFrame(decisions, D), spark.createDataFrame([], X)).collect() == []
