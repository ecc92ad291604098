"""Outlines and texts held against each other: in-order matches, breadcrumbs, nesting, reading order, entry regions, packing."""

from __future__ import annotations

from bisect import bisect_left
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscan.functions import text as X

from .structure import as_of, toc_chains

# How far behind its page an entry's heading is looked for, in characters; a line that is a heading.
ENTRY_WINDOW = 40_000
HEADING_LINE = r"^\s*(#{1,6}\s+\S.*|\*\*[^*].*\*\*)\s*$"
# End of fixed values.


def ranked_spans(toc: DataFrame, doc: list[str]) -> DataFrame:
    """toc (doc, idx, level, title, page) with rank, in order of page, and end_rank: the rank of the next entry that is no deeper, else one past the last.

    Entries of one level or above end each other, so the next no-deeper entry is found by one ordered pass over a document's outline, however deep it is.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in toc.schema)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["page", "idx"], kind="stable").reset_index(drop=True)
        end, open_ = [len(rows) + 1] * len(rows), []
        for k, level in enumerate(rows["level"].tolist()):
            while open_ and open_[-1][1] >= level:
                end[open_.pop()[0]] = k + 1
            open_.append((k, level))
        return rows.assign(rank=range(1, len(rows) + 1), end_rank=end)

    return toc.groupBy(*doc).applyInPandas(of, f"{fields}, rank long, end_rank long")


def nested(outer: DataFrame, spans: DataFrame, doc: list[str]) -> DataFrame:
    """outer (doc, pair, outer, inner: title keys) with nests: whether an entry of the outer title encloses one of the inner; true where the outline has no pages for one of them. spans: (doc, title_key, rank, end_rank)."""
    s = spans.filter("rank is not null")
    a = s.select(*doc, F.col("title_key").alias("outer"), F.col("rank").alias("_a"), F.col("end_rank").alias("_e"))
    b = s.select(*doc, F.col("title_key").alias("inner"), F.col("rank").alias("_b"))
    met = outer.join(a, [*doc, "outer"], "left").join(b, [*doc, "inner"], "left")
    hit = F.when(F.col("_a").isNull() | F.col("_b").isNull(), True).otherwise((F.col("_a") < F.col("_b")) & (F.col("_b") < F.col("_e")))
    return met.groupBy(*doc, "pair", "outer", "inner").agg(F.bool_or(hit).alias("nests"))


def out_of_order(chunks: DataFrame, spans: DataFrame, doc: list[str]) -> DataFrame:
    """(doc, ord, back_to, after) of chunks whose deepest ancestor stands before where the chunks got to and does not enclose it. chunks: (doc, ord, title_key of the ancestor).

    The place is kept where an entry encloses it, moves ahead to the nearest entry otherwise, and stays where neither is there: a fold over one document's chunks.
    """
    met = chunks.join(spans.filter("rank is not null").select(*doc, "title_key", "rank", "end_rank"), [*doc, "title_key"]).select(*doc, "ord", "rank", "end_rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in met.select(*doc).schema)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        at, out = 0, []
        for ord_, own in rows.sort_values(["ord", "rank"]).groupby("ord", sort=True):
            ranks = own["rank"]
            if ((ranks <= at) & (at < own["end_rank"])).any():
                continue
            ahead = ranks[ranks >= at]
            if len(ahead):
                at = int(ahead.min())
            else:
                out.append((ord_, int(ranks.min()), at))
        found = pd.DataFrame(out, columns=["ord", "back_to", "after"])
        for c in reversed(doc):
            found.insert(0, c, rows[c].iloc[0])
        return found

    return met.groupBy(*doc).applyInPandas(of, f"{fields}, ord long, back_to long, after long")


def heading_lines(chunks: DataFrame, doc: list[str], title: str = "title", body: str = "body") -> DataFrame:
    """(doc, ord, line, opens, key): headings outside code, and whether one opens its chunk: no other line but breadcrumbs before it. line orders headings of a document."""
    flat = chunks.select(*doc, "ord", F.col(title).alias("_title"), F.posexplode(X.lines(F.coalesce(F.col(body), F.lit("")))).alias("pos", "raw")).filter(F.trim(F.regexp_replace("raw", r"\s", "")) != "")
    by = Window.partitionBy(*doc, "ord").orderBy("pos")
    fence = F.col("raw").rlike(r"^\s*```")
    s = F.trim("raw")
    crumb = s.startswith("*") & s.endswith("*") & (F.length(s) > 2) & F.trim(F.expr("substring(trim(raw), 2, length(trim(raw)) - 2)")).startswith(F.trim("_title"))
    flat = flat.withColumn("_fence", fence).withColumn("_code", F.sum(fence.cast("int")).over(by) % 2 == 1)
    # The first line that is no breadcrumb opens the chunk.
    flat = flat.withColumn("_before", F.sum((~crumb | F.col("_fence")).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, -1)))
    opens = F.coalesce(F.col("_before"), F.lit(0)) == 0
    heads = flat.withColumn("opens", opens).filter(~F.col("_fence") & ~F.col("_code") & ~(F.col("opens") & crumb) & F.col("raw").rlike(HEADING_LINE))
    return heads.select(*doc, "ord", (F.col("ord").cast("long") * (1 << 24) + F.col("pos")).alias("line"), "opens", X.norm_title("raw").alias("key"))


def longest_in_order(pairs: list[tuple[int, int, bool]]) -> list[tuple[int, int]]:
    """The longest run of (line, entry) that rises in both; pairs (line, entry, opens) come by line, and entries of one line fall, so that a line has one entry at most.

    Of two lines for one entry the earlier stays, unless only the later opens a chunk.
    """
    ends: list[int] = []
    best: list[tuple[int, int, bool, object]] = []  # (line, entry, opens, what came before)
    for line, entry, opens in pairs:
        k = bisect_left(ends, entry)
        if k < len(ends) and ends[k] == entry and (best[k][2] or not opens):
            continue
        node = (line, entry, opens, best[k - 1] if k else None)
        ends[k : k + 1], best[k : k + 1] = [entry], [node]
    out, node = [], best[-1] if best else None
    while node:
        out.append((node[0], node[1]))
        node = node[3]
    return out[::-1]


def in_order(pairs: DataFrame, doc: list[str]) -> DataFrame:
    """pairs (doc, line, entry, opens) that are kept: (doc, line, entry). One document's pairs meet in one task."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.select(*doc).schema)

    def of(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["line", "entry"], ascending=[True, False])
        found = pd.DataFrame(longest_in_order(list(zip(rows["line"].tolist(), rows["entry"].tolist(), rows["opens"].tolist(), strict=True))), columns=["line", "entry"])
        for c in reversed(doc):
            found.insert(0, c, rows[c].iloc[0])
        return found

    return pairs.groupBy(*doc).applyInPandas(of, f"{fields}, line long, entry long")


def longest_of_keys(lines: list[tuple[int, str, bool]], entries: dict[str, np.ndarray]) -> list[tuple[int, int]]:
    """As longest_in_order() for every pair of a line (line, key, opens) and an entry of its key, without the pairs. entries: ascending numbers of each key.

    Of a line's entries between two ends of runs only the least can become the end of one, so all of a line are placed by one search. Runs are chains of
    numbers in arrays; those that no run needs any more go when the arrays have doubled.
    """
    ends, best, n = np.empty(1024, np.int64), np.empty(1024, np.int64), 0
    # Of each node: line, entry, whether the line opens its chunk, the node before it.
    nodes, used, most = np.empty((4, 4096), np.int64), 0, 4096
    for at, group in groupby(sorted(lines, key=lambda x: x[0]), key=lambda x: x[0]):
        own = [(entries[key], opens) for _, key, opens in group if key in entries]
        if not own:
            continue
        found, opens = own[0][0], np.full(len(own[0][0]), own[0][1])
        if len(own) > 1:  # a place that several rows have
            found = np.unique(np.concatenate([e for e, _ in own]))
            opens = np.logical_or.reduce([np.isin(found, e) & o for e, o in own])
        k = np.searchsorted(ends[:n], found)
        least = np.concatenate([[True], k[1:] != k[:-1]])
        k, found, opens = k[least], found[least], opens[least]
        there = k < n
        same = np.zeros(len(k), bool)
        same[there] = ends[k[there]] == found[there]
        same[same] = ~opens[same] | (nodes[2, best[k[same]]] != 0)
        k, found, opens = k[~same], found[~same], opens[~same]
        if not len(k):
            continue
        if used + len(k) > nodes.shape[1]:
            if used >= most:  # keep what the runs need
                needed, heads = np.zeros(used, bool), np.unique(best[:n])
                while len(heads):
                    needed[heads] = True
                    heads = np.unique(nodes[3, heads])
                    heads = heads[heads >= 0]
                    heads = heads[~needed[heads]]
                number = np.cumsum(needed) - 1
                kept = nodes[:, :used][:, needed]
                kept[3] = np.where(kept[3] >= 0, number[kept[3]], -1)
                best[:n], used = number[best[:n]], kept.shape[1]
                most = max(4096, 2 * used)
                nodes = kept
            nodes = np.concatenate([nodes[:, :used], np.empty((4, max(used, len(k), 4096)), np.int64)], axis=1)
        new = np.arange(used, used + len(k))
        nodes[0, new], nodes[1, new], nodes[2, new], nodes[3, new] = at, found, opens, np.where(k > 0, best[np.maximum(k, 1) - 1], -1) if n else -1
        used += len(k)
        if n == len(ends):
            ends, best = np.concatenate([ends, ends]), np.concatenate([best, best])
        ends[k], best[k] = found, new
        n = max(n, int(k[-1]) + 1)
    out, node = [], int(best[n - 1]) if n else -1
    while node >= 0:
        out.append((int(nodes[0, node]), int(nodes[1, node])))
        node = int(nodes[3, node])
    return out[::-1]


def in_order_by_key(lines: DataFrame, entries: DataFrame, doc: list[str]) -> DataFrame:
    """As in_order() for all pairs of lines (doc, line, key, opens) and entries (doc, key, entry) of one key: (doc, line, entry). One document's lines and entries meet in one task, their pairs are not made."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.select(*doc).schema)

    def of(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        numbers = {key: np.unique(own.to_numpy(np.int64)) for key, own in b.groupby("key")["entry"]}
        found = pd.DataFrame(longest_of_keys(list(zip(a["line"].tolist(), a["key"].tolist(), a["opens"].tolist(), strict=True)), numbers), columns=["line", "entry"])
        for c in reversed(doc):
            found.insert(0, c, a[c].iloc[0] if len(a) else None)
        return found

    # Both may come from one table: their columns get names of their own.
    own = [F.col(c).alias(f"_{c}") for c in doc]
    theirs = entries.filter("key is not null").select(*own, "key", "entry").groupBy(*[f"_{c}" for c in doc])
    return lines.filter("key is not null").select(*doc, "line", "key", "opens").groupBy(*doc).cogroup(theirs).applyInPandas(of, f"{fields}, line long, entry long")


def breadcrumbs(chunks: DataFrame, toc: DataFrame, doc: list[str]) -> DataFrame:
    """chunks (doc, ord, title, body) with breadcrumb: the title and, for a chunk that opens with a heading whose match runs in order with the others, the entries above it.

    Titles that repeat are told apart by their order; a chunk without such a match gets the title alone.
    """
    titles = chunks.select(*doc, X.norm_title("title").alias("_own")).distinct()
    entries = toc.join(titles, doc).withColumn("key", X.norm_title("title"))
    chains = toc_chains(entries, doc).select(*doc, F.col("idx").cast("long").alias("entry"), "chain", "_own")
    up = F.filter(F.slice("chain", F.lit(1), F.greatest(F.size("chain") - 1, F.lit(0))), lambda t: X.norm_title(t) != F.col("_own"))
    heads = heading_lines(chunks, doc)
    named = entries.filter((F.col("key") != "") & (F.col("key") != F.col("_own"))).select(*doc, "key", F.col("idx").cast("long").alias("entry"))
    kept = in_order_by_key(heads.select(*doc, "line", "key", "opens"), named, doc)
    own = kept.join(heads.filter("opens"), [*doc, "line"]).join(chains.select(*doc, "entry", up.alias("_up")), [*doc, "entry"]).select(*doc, "ord", "_up")
    met = chunks.join(own, [*doc, "ord"], "left")
    return met.withColumn("breadcrumb", F.array_join(F.concat(F.array("title"), F.coalesce("_up", F.array().cast("array<string>"))), X.CRUMB)).drop("_up")


def apply_breadcrumb(body: Column | str, breadcrumb: Column | str, title: Column | str) -> Column:
    """A body under its breadcrumb as a line in italics: in place of one that is there, else before the text. Applied twice, it changes nothing more."""
    b, crumb, t = (F.col(x) if isinstance(x, str) else x for x in (body, breadcrumb, title))
    bare = F.regexp_replace(b, r"^(?:[ \t\r]*\n)+", "")
    first = F.trim(F.substring_index(bare, "\n", 1))
    there = first.startswith("*") & first.endswith("*") & (F.length(first) > 2) & F.trim(F.substring(first, F.lit(2), F.length(first) - 2)).startswith(F.trim(t))
    line = F.concat(F.lit("*"), crumb, F.lit("*"))
    rest = F.substring(bare, F.length(F.substring_index(bare, "\n", 1)) + 1, F.length(bare))
    return F.when(there, F.concat(line, rest)).otherwise(F.concat(line, F.lit("\n\n"), b))


def chain_at(places: DataFrame, toc: DataFrame, doc: list[str]) -> DataFrame:
    """places (doc, page, y) with chain: the headings in force there. toc: (doc, idx, level, title, page, y), in order of place."""
    at = lambda p, y: F.col(p).cast("double") * 100_000 + F.coalesce(F.col(y).cast("double"), F.lit(0.0))
    marks = toc_chains(toc, doc).withColumn("_at", at("page", "y")).select(*doc, "_at", "chain")
    # Of entries at one place the last in the outline is in force.
    last = marks.groupBy(*doc, "_at").agg(F.max_by("chain", F.size("chain")).alias("chain"))
    return as_of(places.withColumn("_p", at("page", "y")), last, doc, "_p", "_at", "chain", "chain").drop("_p")


def anchored(chunks: DataFrame, spans: DataFrame, doc: list[str], fallback: DataFrame | None = None) -> DataFrame:
    """chunks (doc, ord, title_key, page_start, page_end) with entry and how: the outline entry of that title whose pages overlap the chunk's, the nearest by page; else what fallback (doc, ord, entry) says."""
    s = spans.select(*doc, "title_key", F.col("idx").cast("long").alias("_i"), F.col("page").alias("_p"), F.col("end_page").alias("_e"))
    over = (F.col("_p") <= F.col("page_end")) & (F.col("_e").isNull() | (F.col("_e") >= F.col("page_start")))
    met = chunks.join(s, [*doc, "title_key"]).filter(over)
    best = met.groupBy(*doc, "ord").agg(F.min(F.struct(F.abs(F.col("_p") - F.col("page_start")).alias("d"), F.col("_i").alias("i"))).alias("_b")).select(*doc, "ord", F.col("_b.i").alias("_anchor"))
    out = chunks.join(best, [*doc, "ord"], "left")
    if fallback is None:
        return out.withColumn("entry", F.col("_anchor")).withColumn("how", F.when(F.col("_anchor").isNotNull(), "title")).drop("_anchor")
    out = out.join(fallback.select(*doc, "ord", F.col("entry").cast("long").alias("_back")), [*doc, "ord"], "left")
    how = F.when(F.col("_anchor").isNotNull(), "title").when(F.col("_back").isNotNull(), "position")
    return out.withColumn("entry", F.coalesce("_anchor", "_back")).withColumn("how", how).drop("_anchor", "_back")


def entry_regions(toc: DataFrame, pages: DataFrame, headings: DataFrame, sizes: DataFrame, doc: list[str], level: int, window: int = ENTRY_WINDOW) -> DataFrame:
    """(doc, idx, title, start, stop) of the entries of a level: from the entry to the next of that level or above.

    An entry begins with its page (doc, page, start), or with the first heading line (doc, key, offset) of its title within so many characters after that; never before the entry ahead of it.
    sizes: (doc, size) of the text.
    """
    own = toc.filter(F.col("level") <= level).select(*doc, "idx", "level", "title", "page", X.norm_title("title").alias("key")).join(pages.select(*doc, "page", F.col("start").alias("_page")), [*doc, "page"])
    heads = headings.select(*doc, "key", "offset")
    near = own.join(heads, [*doc, "key"], "left").withColumn("_hit", F.when((F.col("offset") >= F.col("_page")) & (F.col("offset") < F.col("_page") + window), F.col("offset")))
    first = near.groupBy(*doc, "idx", "level", "title", "page", "_page").agg(F.min("_hit").alias("_hit"))
    w = Window.partitionBy(*doc).orderBy("page", "idx")
    placed = first.withColumn("start", F.max(F.coalesce("_hit", "_page")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ended = placed.withColumn("_next", F.lead("start").over(w)).join(sizes, doc)
    return ended.filter(F.col("level") == level).select(*doc, "idx", "title", F.col("start").cast("long").alias("start"), F.coalesce("_next", "size").cast("long").alias("stop"))


def packed(pieces: DataFrame, by: list[str], order: str, start: str, stop: str, most: int, least: int | None = None, opens: str | None = None) -> DataFrame:
    """(by, no, first, start, stop, n) of neighbouring pieces put together as long as they stay within `most` from the first's start to the last's stop.

    With `least`, a group is closed as soon as it is so long; with `opens`, before a piece that opens a section. A fold over the pieces of one parent, which are gathered.
    """
    item = F.struct(F.col(order).cast("long").alias("o"), F.col(start).cast("long").alias("a"), F.col(stop).cast("long").alias("b"), (F.col(opens) if opens else F.lit(False)).alias("new"))
    lists = pieces.groupBy(*by).agg(F.sort_array(F.collect_list(item)).alias("p"))
    kind = "array<struct<first:bigint,start:bigint,stop:bigint,n:bigint>>"
    fresh = lambda x: F.struct(x["o"].alias("first"), x["a"].alias("start"), x["b"].alias("stop"), F.lit(1).cast("long").alias("n"))

    def step(groups: Column, x: Column) -> Column:
        last = F.element_at(groups, -1)
        cut = x["b"] - last["start"] > most
        if least is not None:
            cut = cut | (last["stop"] - last["start"] >= least) | x["new"]
        grown = F.struct(last["first"].alias("first"), last["start"].alias("start"), x["b"].alias("stop"), (last["n"] + 1).alias("n"))
        return F.when((F.size(groups) == 0) | cut, F.concat(groups, F.array(fresh(x)))).otherwise(F.concat(F.slice(groups, F.lit(1), F.size(groups) - 1), F.array(grown)))

    folded = lists.select(*by, F.aggregate("p", F.array().cast(kind), step).alias("g"))
    return folded.select(*by, F.posexplode("g").alias("no", "g")).select(*by, "no", "g.first", "g.start", "g.stop", "g.n")
