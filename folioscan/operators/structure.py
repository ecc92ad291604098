"""Structure of documents: outlines, page ranges, breadcrumbs, bounded chunks."""

from __future__ import annotations

import re
from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X

# Sizes of chunks in characters.
MAX_CHUNK, MIN_CHUNK = 9000, 500
# End of fixed values.
#: Levels of outlines that windows serve; deeper ones are folded.
LEVELS = 12


def _depth(toc: DataFrame) -> int:
    """The deepest level of an outline table: one small aggregate."""
    return toc.agg(F.max("level")).first()[0] or 0


def toc_spans(toc: DataFrame, doc: list[str]) -> DataFrame:
    """toc (doc, idx, level, title, page) with end_page: the page of the next entry that is no deeper, in order of page; null to the end.

    One window frame a level looks ahead for entries of that level or above, so no pairs are made. Outlines of more than LEVELS levels are folded, document by document.
    """
    if _depth(toc) > LEVELS:
        return _folded(toc, doc, ["page", "idx"], "end_page long", _ends)
    ahead = Window.partitionBy(*doc).orderBy("page", "idx").rowsBetween(1, Window.unboundedFollowing)
    out: Column = F.lit(None).cast("long")
    for level in range(LEVELS, 0, -1):
        nxt = F.first(F.when(F.col("level") <= level, F.col("page")), ignorenulls=True).over(ahead)
        out = F.when(F.col("level") == level, nxt).otherwise(out)
    return toc.withColumn("end_page", out.cast("long"))


def toc_chains(toc: DataFrame, doc: list[str]) -> DataFrame:
    """toc with chain: the titles above each entry and its own, in reading order.

    The ancestor of each level is the last entry of that level since the last shallower one: a running maximum
    of positions by level, without a stack. Outlines of more than LEVELS levels are folded, document by document.
    """
    if _depth(toc) > LEVELS:
        return _folded(toc, doc, ["idx"], "chain array<string>", _chains)
    w = Window.partitionBy(*doc).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    titles, valid = [], []
    for level in range(1, LEVELS + 1):
        last = F.max(F.when(F.col("level") == level, F.struct("idx", "title"))).over(w)
        cut = F.max(F.when(F.col("level") < level, F.col("idx"))).over(w)
        titles.append(last)
        valid.append((F.lit(level) <= F.col("level")) & last.isNotNull() & (cut.isNull() | (last["idx"] > cut)))
    parts = [F.when(v, F.array(t["title"])).otherwise(F.array().cast("array<string>")) for t, v in zip(titles, valid, strict=True)]
    return toc.withColumn("chain", F.concat(*parts))


def _folded(toc: DataFrame, doc: list[str], order: list[str], out: str, fold) -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in toc.schema)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable").reset_index(drop=True)
        return rows.assign(**{out.split()[0]: pd.Series(fold(rows), dtype=object)})

    return toc.groupBy(*doc).applyInPandas(of, f"{fields}, {out}")


def _ends(rows: pd.DataFrame) -> list:
    end, open_ = [None] * len(rows), []
    for k, (level, page) in enumerate(zip(rows["level"].tolist(), rows["page"].tolist(), strict=True)):
        while open_ and open_[-1][1] >= level:
            end[open_.pop()[0]] = page
        open_.append((k, level))
    return end


def _chains(rows: pd.DataFrame) -> list:
    out, open_ = [], []
    for level, title in zip(rows["level"].tolist(), rows["title"].tolist(), strict=True):
        while open_ and open_[-1][0] >= level:
            open_.pop()
        open_.append((level, title))
        out.append([t for _, t in open_])
    return out


def as_of(rows: DataFrame, marks: DataFrame, doc: list[str], at: str, mark_at: str, value: str, out: str) -> DataFrame:
    """rows with the value of the last mark at or before `at`, by one union and one window: no pairs are made."""
    both = rows.withColumn("_row", F.struct(*rows.columns)).select(*doc, F.col(at).alias("_at"), F.lit(1).alias("_side"), "_row", F.lit(None).cast(marks.schema[value].dataType).alias("_v"))
    flags = marks.select(*doc, F.col(mark_at).alias("_at"), F.lit(0).alias("_side"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"))
    w = Window.partitionBy(*doc).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.unionByName(flags).withColumn("_last", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1").select("_row.*", F.col("_last").alias(out))


def page_ranges(chunks: DataFrame, pages: DataFrame, doc: list[str]) -> DataFrame:
    """chunks (doc, ord, start, stop: offsets) with page_start and page_end, from pages (doc, page, start)."""
    one = as_of(chunks, pages, doc, "start", "start", "page", "page_start").withColumn("_last", F.greatest(F.col("stop") - 1, F.col("start")))
    return as_of(one, pages, doc, "_last", "start", "page", "page_end").drop("_last")


def contained(points: DataFrame, ranges: DataFrame, by: list[str], at: str, start: str, end: str, width: int = 64) -> DataFrame:
    """Every (point, range) with the point in the range, ends included. Ranges are cut into buckets of `width`, so the join has an equality."""
    left = points.withColumn("_bucket", F.floor(F.col(at) / width))
    right = ranges.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    return left.join(right, [*by, "_bucket"]).filter(F.col(at).between(F.col(start), F.col(end))).drop("_bucket")


def only_range(points: DataFrame, ranges: DataFrame, by: list[str], point_id: str, at: str, start: str, end: str, value: str) -> DataFrame:
    """(point_id, value) where exactly one range holds the point; where several do, it stays undecided and out."""
    met = contained(points, ranges, by, at, start, end).groupBy(point_id).agg(F.count("*").alias("_n"), F.min(value).alias(value))
    return met.filter("_n = 1").drop("_n")


def overlapping(spans: DataFrame, chunks: DataFrame, key: list[str]) -> DataFrame:
    """chunks (key, ord, page_start, page_end) with verdict: true if a span of the same key overlaps, false if none does, null without pages or spans. Spans end where they begin, or after.

    No pairs are made: spans that begin by the chunk's end, less those that end before its start, are running counts over one ordered union.
    """
    nil = F.lit(None).cast("long")
    c = chunks.filter("page_start is not null and page_end is not null").select(*key, "ord", "page_start", "page_end")
    begun = c.select(*key, F.col("page_end").cast("long").alias("_at"), F.lit(2).alias("_side"), "ord", "page_start", "page_end")
    over = c.select(*key, F.col("page_start").cast("long").alias("_at"), F.lit(0).alias("_side"), "ord", "page_start", "page_end")
    own = spans.filter("page is not null")
    pad = [nil.cast(c.schema["ord"].dataType).alias("ord"), nil.cast(c.schema["page_start"].dataType).alias("page_start"), nil.cast(c.schema["page_end"].dataType).alias("page_end")]
    starts = own.select(*key, F.col("page").cast("long").alias("_at"), F.lit(1).alias("_side"), *pad)
    # A span that ends at e is over for chunks that start at e + 1: its row stands before theirs there, and counts with the sign of side -1.
    ends = own.filter("end_page is not null").select(*key, (F.col("end_page") + 1).cast("long").alias("_at"), F.lit(-1).alias("_side"), *pad)
    w = Window.partitionBy(*key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    every = begun.unionByName(over).unionByName(starts).unionByName(ends)
    counted = every.withColumn("_begun", F.count_if(F.col("_side") == 1).over(w)).withColumn("_over", F.count_if(F.col("_side") == -1).over(w))
    hits = counted.filter("_side in (0, 2)").groupBy(*key, "ord", "page_start", "page_end").agg(F.max(F.when(F.col("_side") == 2, F.col("_begun"))).alias("_b"), F.max(F.when(F.col("_side") == 0, F.col("_over"))).alias("_o"))
    known = own.select(*key).distinct().withColumn("_known", F.lit(True))
    verdict = F.when(F.col("_known"), F.col("_b") > F.col("_o"))
    met = hits.join(known, key, "left").select(*key, "ord", verdict.alias("verdict"))
    return chunks.select(*key, "ord").join(met, [*key, "ord"], "left")


def neighbours(rows: DataFrame, wanted: DataFrame, doc: list[str], ord_: str, around: int) -> DataFrame:
    """Rows at most `around` places from a wanted (doc, ord): each wanted place makes 2 * around + 1 keys of an equality join."""
    keys = wanted.select(*doc, F.col(ord_).alias("at"), F.explode(F.sequence(F.col(ord_) - around, F.col(ord_) + around)).alias(ord_))
    return keys.join(rows, [*doc, ord_])


def fence_state(lines: DataFrame, doc: list[str], pos: str = "pos", line: str = "line") -> DataFrame:
    """lines with in_code: between lines of three back-ticks; these count as code themselves."""
    fence = F.col(line).rlike(r"^\s*```")
    w = Window.partitionBy(*doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("in_code", fence | (F.sum(F.when(fence, 1).otherwise(0)).over(w) % 2 == 1))


def dedupe_slugs(rows: DataFrame, doc: list[str], slug: str, ord_: str) -> DataFrame:
    """The n-th repeat of a slug in a document gets -n."""
    n = F.row_number().over(Window.partitionBy(*doc, slug).orderBy(ord_))
    return rows.withColumn("_n", n).withColumn(slug, F.when(F.col("_n") > 1, F.concat(F.col(slug), F.lit("-"), F.col("_n").cast("string"))).otherwise(F.col(slug))).drop("_n")


def page_fill(rows: DataFrame, doc: list[str], ord_: str, page: str) -> DataFrame:
    """Pages of rows without one: the last before, else the next after."""
    before = Window.partitionBy(*doc).orderBy(ord_).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*doc).orderBy(ord_).rowsBetween(0, Window.unboundedFollowing)
    return rows.withColumn(page, F.coalesce(F.last(page, ignorenulls=True).over(before), F.first(page, ignorenulls=True).over(after)))


def backwards(rows: DataFrame, doc: list[str], ord_: str, page: str) -> DataFrame:
    """Rows whose page is before that of the last row with one."""
    w = Window.partitionBy(*doc).orderBy(ord_).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.last(page, ignorenulls=True).over(w)).filter(F.col(page) < F.col("before"))


# Bounded chunks: sequential within one text, so they are made in one call a text.

_heading = re.compile(r"^(#{1,6})[ \t]+(.+?)[ \t]*$", re.M)
_bold = re.compile(r"^\*\*([^*\n]{2,80})\*\*[ \t]*$", re.M)
_fence = re.compile(r"^[ \t]*```", re.M)
INTRO = "(intro)"


class Headings:
    """The headings of a text outside fenced code, by level and place; found once, however often a part is cut. With `bold`, lines that are bold and nothing else are headings too."""

    def __init__(self, text: str, bold: bool = False):
        self.by_level: list[list[tuple[int, str]]] = [[] for _ in range(7)]
        fences = [m.start() for m in _fence.finditer(text)]
        code = lambda at: bisect_left(fences, at) % 2 == 1
        for m in _heading.finditer(text):
            if any(c.isalnum() for c in m[2]) and not code(m.start()):
                self.by_level[len(m[1])].append((m.start(), m[2].strip()))
        self.bold = [(m.start(), f"**{m[1].strip()}**") for m in _bold.finditer(text) if not code(m.start())] if bold else []

    @staticmethod
    def _within(own: list[tuple[int, str]], a: int, b: int) -> list[tuple[int, str]]:
        return own[bisect_left(own, (a, "")) : bisect_left(own, (b, ""))]

    def top(self) -> list[tuple[int, int, str]]:
        found = {at: (at, 2, t) for at, t in self.bold}
        found |= {at: (at, level, t) for level in (1, 2) for at, t in self.by_level[level]}
        return sorted(found.values())

    def below(self, level: int, a: int, b: int) -> list[tuple[int, int, str]]:
        """Headings of the shallowest level from `level` on that text[a:b] has."""
        for lv in range(level, 7):
            if found := self._within(self.by_level[lv], a, b):
                return [(at, lv, t) for at, t in found]
        return [(at, level, t) for at, t in self._within(self.bold, a, b)]


Span = tuple[str, int, int, int]  # heading, level, start, stop


def _cut(text: str, marks: list[tuple[int, int, str]], a: int, b: int, heading: str = INTRO, level: int = 0) -> list[Span]:
    """text[a:b] cut at the marks; what stands before the first is an introduction, unless it is blank."""
    edges = [at for at, *_ in marks] + [b]
    out = [(heading, level, a, edges[0])] if text[a : edges[0]].strip() else []
    return out + [(t, lv, at, end) for (at, lv, t), end in zip(marks, edges[1:], strict=True)]


def _grouped(spans: list[Span], closed) -> list[Span]:
    """Neighbours joined until closed(group, next) says so; a group has the heading of its first."""
    out: list[Span] = []
    for s in spans:
        if out and not closed(out[-1], s):
            out[-1] = (*out[-1][:3], s[3])
        else:
            out.append(s)
    return out


def _paragraphs(text: str, heading: str, level: int, a: int, b: int, most: int) -> list[Span]:
    """text[a:b] in pieces of whole paragraphs, parted where the next would not fit; a paragraph that is too long itself is cut at lines, else anywhere."""
    edges = [a, *(m.end() for m in re.compile("\n\n").finditer(text, a, b))]
    pieces: list[tuple[int, int]] = []
    used = 0
    for p, q in zip(edges, [*edges[1:], b + 2], strict=True):
        size = q - p
        if pieces and used + size <= most:
            pieces[-1], used = (pieces[-1][0], q - 2), used + size
        else:
            pieces.append((p, q - 2))
            used = size
    out = []
    for p, q in pieces:
        while q - p > most:
            at = text.rfind("\n", p, p + most)
            at = at if at > p else p + most
            out.append((p, at))
            p = at
        if p < q or not out:
            out.append((p, q))
    return [(heading if k == 0 else f"{heading} (cont.)", level, p, q) for k, (p, q) in enumerate(out)] if len(out) > 1 else [(heading, level, *out[0])]


def _bounded(text: str, own: Headings, span: Span, most: int) -> list[Span]:
    """A span in pieces of at most `most` characters: at the shallowest deeper headings, again where a piece is too long, siblings packed; without such headings, at paragraphs."""
    heading, level, a, b = span
    if b - a <= most:
        return [span]
    intro = INTRO if heading == INTRO else f"{heading} {INTRO}"
    parts = _cut(text, marks, a, b, intro, level) if (marks := own.below(level + 1, a, b)) else []
    if len(parts) < 2:
        return _paragraphs(text, heading, level, a, b, most)
    return _grouped([x for p in parts for x in _bounded(text, own, p, most)], lambda g, s: s[3] - g[2] > most)


def chunk_spans(text: str, most: int = MAX_CHUNK, least: int = MIN_CHUNK, bold: bool = False, sections: frozenset[str] = frozenset()) -> list[Span]:
    """(heading, level, start, stop) of chunks of at most `most` characters; only blanks are in none.

    Cut at headings of the first two levels (and bold lines, if asked), see _bounded for what is too long; then neighbours are joined until they have `least` characters, never across
    a heading of `sections` (title keys).
    """
    own = Headings(text, bold)
    top = own.top()
    spans = _cut(text, top, 0, len(text)) if top else [(INTRO, 0, 0, len(text))] if text.strip() else []
    pieces = [x for s in spans for x in _bounded(text, own, s, most)]
    return _grouped(pieces, lambda g, s: g[3] - g[2] >= least or s[3] - g[2] > most or section_key(s[0]) in sections)


def section_key(heading: str) -> str:
    bare = re.sub(r"\s*\((?:intro|cont\.)\)\s*$", "", heading).strip("#*_` ")
    return " ".join(re.sub(r"(?i)^(?:chapter|appendix|section)\s+\w{1,4}\s*[:.]?\s+|^\d+(?:\.\d+)*\.?\s+", "", bare).split()).lower()


CHUNKS = "ord int, heading string, level int, start int, stop int, body string"


def chunks(docs: DataFrame, key: list[str], text: str = "text", most: int = MAX_CHUNK, least: int = MIN_CHUNK, bold: bool = False) -> DataFrame:
    """(key, ord, heading, level, start, stop, body) of every document; one Arrow batch out for each in."""
    from .passages import mapped

    def make(own: str | None):
        own = own or ""
        return ((i, t, lv, a, b, own[a:b]) for i, (t, lv, a, b) in enumerate(chunk_spans(own, most, least, bold)))

    return mapped(docs, key, [text], CHUNKS, make)


def breadcrumbs(chunks_: DataFrame, toc: DataFrame, doc: list[str], title: str = "title") -> DataFrame:
    """chunks (doc, ord, heading, title) with breadcrumb: title and, where exactly one outline entry has the heading, its ancestors.

    A heading that several entries have is not guessed: it gets the title only.
    """
    chain = toc_chains(toc, doc).select(*doc, X.title_key("title").alias("_k"), F.slice("chain", F.lit(1), F.greatest(F.size("chain") - 1, F.lit(0))).alias("_up"))
    sure = chain.groupBy(*doc, "_k").agg(F.count("*").alias("_n"), F.first("_up").alias("_up")).filter("_n = 1").drop("_n")
    met = chunks_.withColumn("_k", X.title_key("heading")).join(sure, [*doc, "_k"], "left")
    return met.withColumn("breadcrumb", F.array_join(F.concat(F.array(F.col(title)), F.coalesce("_up", F.array().cast("array<string>"))), X.CRUMB)).drop("_k", "_up")
