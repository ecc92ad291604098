"""Operator 2: benchmark decontamination by rare n-gram seeds and Smith-Waterman alignment.

1. One pass counts in how many documents each n-gram of the benchmark occurs. Counts are summed in each task
   first; what comes together is as large as the benchmark, not the corpus.
2. Each item keeps its rarest n-grams as seeds: those few documents have, and in any case the rarer half of
   its own, so that an item which is everywhere still has seeds.
3. A second pass looks every n-gram of every text up among the seeds. Where enough distinct seeds of one item meet
   near one diagonal, that passage is aligned with the item word by word (local alignment: match 2, mismatch -1, gap -1).
   The score over that of a perfect match is the similarity.

The benchmark is a stated query set: it goes to the tasks in blocks of bounded size, and every text is held against all of it.

Defined results: null and empty texts and items match nothing; items of fewer words than an n-gram are their own
seed; an item that occurs several times in a text gives one row, the best; rows that repeat a doc_id give their rows
again; empty tables give an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import steps, table, tune

GRAM = 3
#: Least similarity of a passage that counts as a copy.
SIMILARITY = 0.4
#: A seed may be in so large a share of the documents, beyond the rarer half of its item's.
RARE = 0.0005
#: And in so many in any case.
FEW = 20
#: Distinct seeds of an item that must meet.
HITS = 2
#: Bytes of benchmark text in a block.
BLOCK = 8 << 20
LEAKS = "doc_id long, item_id long, similarity double, score long, start_word long, end_word long, n_seeds long"

_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


class Items:
    """A block of the benchmark: numbered words, and n-grams as numbers."""

    def __init__(self, rows: list[tuple[int, str]], gram: int = GRAM):
        self.gram, self.vocabulary = gram, {}
        self.ids, self.tokens = [], []
        for item_id, text in rows:
            words = words_of(text)
            if words:
                self.ids.append(item_id)
                self.tokens.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        self.grams = [self.of(t, min(gram, len(t))) for t in self.tokens]  # (number of each n-gram of an item)
        self.keys = np.unique(np.concatenate(self.grams)) if self.grams else np.empty(0, np.int64)

    def of(self, tokens: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the runs of `size` words; -1 with an unknown word."""
        n = len(tokens) - size + 1
        if n <= 0:
            return np.empty(0, np.int64)
        base, out, known = len(self.vocabulary) + 1 if size < 4 else 1 << 15, np.zeros(n, np.int64), np.ones(n, bool)
        for i in range(size):
            part = tokens[i : i + n]
            out = out * base + part
            known &= part > 0
        return np.where(known, out * 4 + size, -1)

    def sizes(self) -> list[int]:
        return sorted({min(self.gram, len(t)) for t in self.tokens})

    def numbered(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The word numbers of texts one after another (0: not in the benchmark), a 0 after each; starts."""
        found = [words_of(t) for t in texts]
        get, out = self.vocabulary.get, []
        for words in found:
            out += [get(w, 0) for w in words]
            out.append(0)
        starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in found])]).astype(np.int64)
        return np.array(out, np.int64), starts

    def hits(self, tokens: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, index into keys) of every n-gram that is one of the sorted keys."""
        at, index = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size in self.sizes():
            own = self.of(tokens, size)
            where = np.flatnonzero(own >= 0)
            found = np.searchsorted(keys, own[where])
            found[found == len(keys)] = 0
            same = keys[found] == own[where] if len(keys) else np.zeros(len(where), bool)
            at.append(where[same])
            index.append(found[same])
        return np.concatenate(at), np.concatenate(index)


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, first word, last word + 1) in the passage. Unknown words (0) match nothing."""
    n = len(passage)
    j = np.arange(n + 1)
    row, begin = np.zeros(n + 1, np.int64), j.copy()
    best = (0, 0, 0)
    for word in item.tolist():
        gain = np.where(passage == word, 2, -1) if word else np.full(n, -1)
        diagonal, up = row[:-1] + gain, row[1:] - 1
        take = diagonal >= up
        new, origin = np.zeros(n + 1, np.int64), j.copy()
        new[1:] = np.maximum(np.where(take, diagonal, up), 0)
        origin[1:] = np.where(new[1:] > 0, np.where(take, begin[:-1], begin[1:]), j[1:])
        # A gap in the item: carry the best of what stands to the left, one point a word.
        carried = np.maximum.accumulate(new + j)
        source = np.maximum.accumulate(np.where(new + j == carried, j, 0))
        row, begin = carried - j, origin[source]
        top = int(row.argmax())
        if row[top] > best[0]:
            best = (int(row[top]), int(begin[top]), top)
    return best


def counted(docs: DataFrame, items: Items) -> dict[int, int]:
    """In how many documents each n-gram of the block is; as many entries as the block has n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(items.keys), np.int64)
        for batch in steps(batches, "text", 8 << 20):
            tokens, starts = items.numbered(batch.column("text").to_pylist())
            at, index = items.hits(tokens, items.keys)
            doc = np.searchsorted(starts, at, side="right") - 1
            pairs = np.unique(doc * len(total) + index)
            total += np.bincount(pairs % len(total), minlength=len(total)) if len(pairs) else 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(items.keys[some]), pa.array(total[some])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r.gram: r.n for r in rows}


class Seeds:
    """The seeds of a block: sorted keys and, for each, where they stand in which items."""

    def __init__(self, items: Items, counts: dict[int, int], n_docs: int, rare: float = RARE, hits: int = HITS):
        places, self.need = defaultdict(list), []
        for i, grams in enumerate(items.grams):
            distinct = sorted(set(grams.tolist()), key=lambda g: (counts.get(g, 0), g))
            keep = {g for k, g in enumerate(distinct) if k < max(4, (len(distinct) + 1) // 2) or counts.get(g, 0) <= max(FEW, rare * n_docs)}
            self.need.append(min(hits, len(keep)))
            for q, g in enumerate(grams.tolist()):
                if g in keep:
                    places[g].append((i, q))
        self.keys = np.array(sorted(places), np.int64)
        self.places = [places[g] for g in self.keys.tolist()]


def leaks_in(items: Items, seeds: Seeds, texts: list[str | None], similarity: float = SIMILARITY) -> list[tuple]:
    """(text, item, similarity, score, start, end, seeds) of every copy in texts."""
    tokens, starts = items.numbered(texts)
    at, index = items.hits(tokens, seeds.keys)
    if not len(at):
        return []
    doc = np.searchsorted(starts, at, side="right") - 1
    met = defaultdict(list)
    for d, p, k in zip(doc.tolist(), (at - starts[doc]).tolist(), index.tolist(), strict=True):
        for i, q in seeds.places[k]:
            met[d, i].append((p - q, k))
    out = []
    for (d, i), found in met.items():
        if len({k for _, k in found}) < seeds.need[i]:
            continue
        item, text, best = items.tokens[i], tokens[starts[d] : starts[d + 1] - 1], None
        found.sort()
        slack, groups = max(4, len(item) // 2), [[found[0]]]
        for f in found[1:]:
            if f[0] - groups[-1][-1][0] > slack:
                groups.append([])
            groups[-1].append(f)
        for g in groups:
            n = len({k for _, k in g})
            if n < seeds.need[i]:
                continue
            lo, hi = max(0, g[0][0] - slack), min(len(text), g[-1][0] + len(item) + slack)
            score, a, b = align(text[lo:hi], item)
            like = score / (2 * len(item))
            if like >= similarity and (best is None or (like, -lo) > (best[2], -best[4])):
                best = (d, items.ids[i], like, score, lo + a, lo + b, n)
        if best:
            out.append(best)
    return out


def blocks_of(benchmark: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of bounded size, in order of item_id."""
    rows, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).orderBy("item_id", "text").toLocalIterator():
        rows.append((r[0], r[1] or ""))
        size += len(r[1] or "")
        if size >= block:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def plans(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> list:
    """(items, seeds) of each block, as broadcasts."""
    tune(spark)
    n_docs, out = docs.count(), []
    for rows in blocks_of(benchmark):
        items = Items(rows)
        if items.tokens:
            out.append(spark.sparkContext.broadcast((items, Seeds(items, counted(docs, items), n_docs))))
    return out


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document and item of which it holds an exact or edited copy."""
    blocks = plans(spark, docs, benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in LEAKS.split(", ")]
        for batch in steps(batches, "text", 8 << 20):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(ids[f[0]], *f[1:]) for b in blocks for f in leaks_in(*b.value, texts, similarity)]
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "similarity" else pa.int64()) for n, c in zip(names, cols, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, LEAKS)


def without_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that hold no copy of an item, with all their columns."""
    blocks = plans(spark, docs, benchmark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", 8 << 20):
            texts, keep = batch.column("text").to_pylist(), np.ones(batch.num_rows, bool)
            for b in blocks:
                keep[[f[0] for f in leaks_in(*b.value, texts, similarity)]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
