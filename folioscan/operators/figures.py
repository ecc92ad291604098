"""Figures: which caption is whose on a page, which section a figure belongs to, what of an earlier reading still holds."""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscan.functions import labels as N

from .compare import shingles
from .structure import contained

# The least side and area of a picture, how far a caption may be from it, slack between boxes; boxes with text; a contents row.
MIN_SIDE, MIN_AREA, CAPTION_GAP, SLACK = 36, 4000, 90, 2
TEXT_BOXES = ("caption", "text", "section-header", "list-item", "title")
DOT_LEADER = r"\.\s?\.\s?\.\s?\."
# Words of the paragraph above a figure that are looked for, the fewest it needs, sections after the last figure's that are near.
CONTEXT_WORDS, CONTEXT_LEAST, NEAR = 8, 5, 6
# End of fixed values.


def captions_of(boxes: DataFrame, page: list[str]) -> DataFrame:
    """(page, box, caption, context) for every picture of some size. boxes: (page, box, kind, x0, y0, x1, y1, lines); null or empty lines are no text.

    Pairs of a picture and a caption above or below it are joined within a page; only their ranks go to the one-to-one choice, page by page:
    caption boxes before other texts, then the least gap, then the order of the boxes. The context is the lowest text above a picture that is nobody's caption.
    """
    wide, high = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    pics = boxes.filter((F.col("kind") == "picture") & (F.least(wide, high) >= MIN_SIDE) & (wide * high >= MIN_AREA)).select(*page, "box", *[F.col(c).alias(f"p{c}") for c in ("x0", "y0", "x1", "y1")])
    texts = boxes.filter(F.col("kind").isin(*TEXT_BOXES) & (F.size("lines") > 0)).select(*page, F.col("box").alias("t"), "kind", "x0", "y0", "x1", "y1", "lines")
    above = F.col("y1") <= F.col("py0") + SLACK
    below = F.col("y0") >= F.col("py1") - SLACK
    gap = F.when(above, F.col("py0") - F.col("y1")).when(below, F.col("y0") - F.col("py1"))
    met = pics.join(texts, page).filter(F.least("x1", "px1") > F.greatest("x0", "px0"))
    near = met.withColumn("gap", gap).filter(N.is_caption(F.get("lines", F.lit(0))) & (F.col("gap") <= CAPTION_GAP))

    # The best pair of a page first; a pair is kept if neither its picture nor its text is in one that is kept already.
    ranks = near.select(*page, F.struct((F.col("kind") != "caption").alias("plain"), "gap", "box", "t").alias("_p")).groupBy(*page).agg(F.sort_array(F.collect_list("_p")).alias("_p"))
    none = F.slice("_p", F.lit(1), F.lit(0))
    kept = F.aggregate("_p", none, lambda have, p: F.when(F.exists(have, lambda h: h["box"].eqNullSafe(p["box"]) | h["t"].eqNullSafe(p["t"])), have).otherwise(F.concat(have, F.array(p))))
    pairs = ranks.select(*page, F.inline(kept)).select(*page, "box", "t")
    own = pairs.join(texts.select(*page, "t", N.caption_text("lines", F.col("kind") == "caption").alias("caption")), [*page, "t"])
    free = met.filter(above).join(pairs.select(*page, "t"), [*page, "t"], "left_anti")
    # Of texts that end at one height the first counts.
    context = free.groupBy(*page, "box").agg(F.max_by(F.array_join("lines", " "), F.struct("y1", (-F.col("t")).alias("t"))).alias("context"))
    return pics.select(*page, "box").join(own.select(*page, "box", "caption"), [*page, "box"], "left").join(context, [*page, "box"], "left").fillna("", ["caption", "context"])


def _caption_hits(sections: DataFrame, figures: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, key, ords): the sections that have a caption, once for all figures that share it. Captions alike have four words in common at their start, or are equal, so that is the key of the join."""
    first = lambda k: F.array_join(F.slice(F.split(k, " "), 1, N.PARTS_ALIKE), " ")
    line = sections.select(*doc, "ord", F.explode(F.split("text", r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]")).alias("_l")).filter(~F.col("_l").rlike(DOT_LEADER))
    own = line.select(*doc, "ord", N.caption_key("_l").alias("_k")).filter(F.col("_k").rlike("^(figure|fig) ")).distinct().withColumn("_f", first(F.col("_k")))
    asked = figures.select(*doc, N.caption_key("caption").alias("_a")).filter("_a <> ''").distinct().withColumn("_f", first(F.col("_a")))
    return asked.join(own, [*doc, "_f"]).filter(N.same_caption("_a", "_k")).groupBy(*doc, F.col("_a").alias("key")).agg(F.sort_array(F.collect_set("ord")).alias("ords"))


def _needle(context: str = "context") -> Column:
    """The last words of a context, as an array; null where it has too few."""
    words = F.split(N.caption_key(context), " ")
    return F.when(F.size(words) >= CONTEXT_LEAST, F.slice(words, F.greatest(F.size(words) - CONTEXT_WORDS + 1, F.lit(1)), CONTEXT_WORDS))


def _context_hits(sections: DataFrame, figures: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, key, ords): the sections that hold the last words of a context, once for all figures that share them. Runs of five words meet first; then each section's text is read once, for all that it met."""
    asked = figures.select(*doc, _needle().alias("_n")).filter("_n is not null").distinct()
    asked = asked.select(*doc, F.array_join("_n", " ").alias("_needle"), F.xxhash64(F.array_join(F.slice("_n", 1, CONTEXT_LEAST), " ")).alias("_g"))
    key = sections.select(*doc, "ord", N.caption_key("text").alias("_text"))
    grams = key.select(*doc, "ord", F.explode(shingles("_text", CONTEXT_LEAST)).alias("_s")).select(*doc, "ord", F.xxhash64("_s").alias("_g"))
    pairs = asked.join(grams, [*doc, "_g"]).groupBy(*doc, "ord").agg(F.collect_set("_needle").alias("_needles"))
    met = pairs.join(key, [*doc, "ord"]).select(*doc, "ord", F.concat(F.lit(" "), "_text", F.lit(" ")).alias("_text"), F.explode("_needles").alias("_needle"))
    holds = F.contains("_text", F.concat(F.lit(" "), "_needle", F.lit(" ")))
    return met.filter(holds).groupBy(*doc, F.col("_needle").alias("key")).agg(F.sort_array(F.collect_set("ord")).alias("ords"))


def links(sections: DataFrame, figures: DataFrame, doc: list[str], paragraphs: bool = True) -> DataFrame:
    """(doc, figure, section, link, by_page, by_context): the section (its ord) a figure belongs to and by what: its caption, else its page, else the paragraph above it.

    sections: (doc, ord, text, page_start, page_end), ord numbered without gaps; figures: (doc, figure, page, caption, context), figure ascending in reading order.
    A caption's or paragraph's first section from the last figure's on counts (for paragraphs: of the next six), elsewhere only the only one; a page that several sections share decides nothing.
    Where sections have pages, paragraphs are asked only if `paragraphs`. Candidates come from joins with equalities; only keys of figures and, once a key, section numbers go to the walk, one document in a task.
    """
    captions, contexts = _caption_hits(sections, figures, doc), _context_hits(sections, figures, doc)
    ranges = sections.filter("page_start is not null and page_end is not null").select(*doc, "ord", "page_start", "page_end")
    on = contained(figures.select(*doc, "figure", "page").filter("page is not null"), ranges, doc, "page", "page_start", "page_end")
    page = on.groupBy(*doc, "figure").agg(F.count("*").alias("_n"), F.min("ord").alias("by_page")).filter("_n = 1").drop("_n")
    paged = sections.groupBy(*doc).agg(F.bool_or(F.col("page_start").isNotNull()).alias("paged"))
    has = F.coalesce(F.col("caption") != "", F.lit(False)).alias("captioned")
    keys = [N.caption_key("caption").alias("_caption"), F.array_join(_needle(), " ").alias("_context")]
    rows = figures.select(*doc, "figure", has, *keys).join(page, [*doc, "figure"], "left").join(paged, doc, "left")
    # Both sides of the walk come from one table: columns get names of their own.
    hits = captions.withColumn("_how", F.lit("caption")).unionByName(contexts.withColumn("_how", F.lit("context"))).select(*[F.col(c).alias(f"_{c}") for c in doc], "_how", "key", "ords")

    def walk(own: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("figure", kind="stable")
        ords = {(how, key): o for how, key, o in zip(found["_how"], found["key"], found["ords"], strict=True)}
        at, out = 0, []
        for r, *keys in zip(own.itertuples(), own["_caption"], own["_context"], strict=True):
            captions, contexts = ords.get(("caption", keys[0]), ()), ords.get(("context", keys[1]), ())
            by_page = None if pd.isna(r.by_page) else int(r.by_page)
            k = bisect_left(captions, at)
            by_caption = captions[k] if k < len(captions) else captions[0] if len(captions) == 1 else None
            k = bisect_left(contexts, at)
            by_context = contexts[k] if k < len(contexts) and contexts[k] < at + NEAR else contexts[0] if len(contexts) == 1 else None
            ways = [("caption", by_caption if r.captioned else None), ("page", by_page), ("context", by_context if paragraphs or not r.paged else None)]
            link, section = next(((how, int(s)) for how, s in ways if s is not None), (None, None))
            at = at if section is None else section
            out.append((section, link, by_page, None if by_context is None else int(by_context)))
        linked = pd.DataFrame(out, columns=["section", "link", "by_page", "by_context"], index=own.index, dtype=object)
        return pd.concat([own[[*doc, "figure"]], linked], axis=1)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in figures.select(*doc, "figure").schema)
    return rows.groupBy(*doc).cogroup(hits.groupBy(*[f"_{c}" for c in doc])).applyInPandas(walk, f"{kinds}, section long, link string, by_page long, by_context long")


def agreement(linked: DataFrame, by: list[str]) -> DataFrame:
    """How many figures each way has linked, and how often page and paragraph say what the caption says."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    ways = [n(F.col("link") == w).alias(f"link_{w}") for w in ("caption", "page", "context")]
    sure = F.col("link") == "caption"
    checks = [n(sure & ((F.col(f"by_{w}") == F.col("section")) if same else (F.col(f"by_{w}") != F.col("section")))).alias(f"{w}_{'agree' if same else 'disagree'}") for w in ("page", "context") for same in (True, False)]
    return linked.groupBy(*by).agg(F.count("*").alias("figures"), *ways, n(F.col("link").isNull()).alias("link_none"), *checks)


def stale_files(old: DataFrame, new: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, file): files of earlier figures that no new one has; only documents that were read again lose files."""
    return old.join(new.select(*doc).distinct(), doc, "left_semi").select(*doc, "file").filter("file is not null").distinct().join(new.select(*doc, "file"), [*doc, "file"], "left_anti")


def carried(new: DataFrame, old: DataFrame, doc: list[str]) -> DataFrame:
    """new figures (doc, id, bbox, fingerprint, …) with ocr: the earlier reading of the same figure in the same box, if the art is the same or was not recorded then."""
    was = old.filter("ocr is not null").groupBy(*doc, "id").agg(F.min_by(F.struct("bbox", "fingerprint", "ocr"), F.xxhash64("bbox", "fingerprint", "ocr")).alias("_was"))
    same = (F.col("_was.bbox") == F.col("bbox")) & (F.col("_was.fingerprint").isNull() | F.coalesce(F.col("_was.fingerprint") == F.col("fingerprint"), F.lit(False)))
    return new.drop("ocr").join(was, [*doc, "id"], "left").withColumn("ocr", F.when(same, F.col("_was.ocr"))).drop("_was")
