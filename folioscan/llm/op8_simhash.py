"""Operator 8: SimHash fingerprints, linked within a Hamming distance over vantage-point trees.

Fingerprints are compared once each, however many documents share them. Two that differ in at most two bits agree in one of three
blocks of bits, so each is dealt to three buckets, one for the bits of each block: three copies at any size, and no pair is lost.
A bucket of more fingerprints than a shard should hold is parted again by three blocks of the bits left, and once more: after that it
holds at most 2**20 fingerprints, so no bucket outgrows a task, however alike fingerprints are. (One tree over all fingerprints would deal each
of them to ever more shards as it deepens: 22 at a depth of 12.) Within a bucket a vantage-point tree parts fingerprints by their
Hamming distance to a pivot; those near a boundary visit the other side too, branches that the triangle bound rules out
are never met, and small leaves are compared pair by pair. Links found are reduced to a spanning
forest before they leave a task, and components follow by large-star and small-star rounds.

Defined results: null and empty texts, and texts of white space, have fingerprint zero and are linked like
any other; one or two words are one shingle; repeated rows with one doc_id give one result row each; rows without a doc_id
are linked, and their component is that of the smallest doc_id, null if there is none; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import stage, steps, table, tune
from ._graph import components

SEED = 42
SHINGLE = 3
DISTANCE = 2
#: Fingerprints that a shard should hold: buckets are packed to shards of about so many, and larger ones are parted.
SHARD = 40_000
#: How often a bucket is parted at most.
LEVELS = 3
#: A node with as few points is compared pair by pair.
LEAF = 128
#: Links a task gathers before it reduces them to a forest.
LINKS = 1 << 20

_words = re.compile(rb"[^\x20\x09-\x0D]+").findall
_lower = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_hashes(text: str | None, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of `size` words, repeats included; fewer words are one run."""
    words = _words((text or "").encode("utf-8", "surrogatepass").translate(_lower))
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], np.uint64)
    # Runs are slices of the words joined by single spaces.
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    runs = map(joined.__getitem__, map(slice, starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(r, seed) for r in runs], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = np.array([simhash(shingle_hashes(t.as_py(), size, seed)) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def distance(points: np.ndarray, pivot: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ pivot).astype(np.int16)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from every node to the least node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        la, lb = label[ia], label[ib]
        if np.array_equal(la, lb):
            break
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(label, nxt := label[label]):
            label = nxt
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


class Links:
    """Pairs found so far; reduced to a forest whenever they grow too many."""

    def __init__(self):
        self.a, self.b, self.n, self.next = [], [], 0, LINKS

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.a.append(a)
            self.b.append(b)
            self.n += len(a)
            if self.n > self.next:
                self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.n:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        a, b = forest(np.concatenate(self.a), np.concatenate(self.b))
        self.a, self.b, self.n, self.next = [a], [b], len(a), len(a) + LINKS
        return a, b


def compare(own: np.ndarray, guests: np.ndarray, within: int, links: Links) -> None:
    """All close pairs of own, and of guests with own, block by block."""
    for i in range(0, len(own), 1024):
        row = own[i : i + 1024]
        for j in range(i, len(own), 1024):
            x, y = np.nonzero(np.bitwise_count(row[:, None] ^ own[None, j : j + 1024]) <= within)
            keep = x + i < y + j
            links.add(row[x[keep]], own[y[keep] + j])
        for j in range(0, len(guests), 1024):
            x, y = np.nonzero(np.bitwise_count(row[:, None] ^ guests[None, j : j + 1024]) <= within)
            links.add(row[x], guests[y + j])


def search(own: np.ndarray, guests: np.ndarray, within: int, links: Links) -> None:
    """Vantage-point recursion: pairs of own, and of guests with own, at a distance of at most `within`.

    own is parted by distance d to a pivot: d <= m inside, the rest outside. By the triangle bound a pair over
    the cut has its inner point at d > m - within, so these visit the outside as guests; guests go wherever a
    partner can be. If points lie too close together to part, they are compared pair by pair.
    """
    todo = [(own, guests, 0)]
    while todo:
        own, guests, tries = todo.pop()
        if len(own) <= LEAF:
            compare(own, guests, within, links)
            continue
        d = distance(own, own[(len(own) // 2 + 7919 * tries) % len(own)])
        m = int(np.partition(d, len(d) // 2)[len(d) // 2])
        if m == int(d.max()):
            m -= 1
        inside = d <= m
        edge = inside & (d > m - within)
        n = int(inside.sum())
        if not 0 < n < len(own) or n + len(own) - n + int(edge.sum()) > 1.8 * len(own):
            if tries < 4:
                todo.append((own, guests, tries + 1))
            else:
                compare(own, guests, within, links)
            continue
        g = distance(guests, own[(len(own) // 2 + 7919 * tries) % len(own)])
        todo.append((own[inside], guests[g <= m + within], 0))
        todo.append((own[~inside], np.concatenate([own[edge], guests[g > m - within]]), 0))


def masks(within: int = DISTANCE, levels: int = LEVELS) -> list[list[int]]:
    """By level, the masks of bits that fingerprints of one bucket share; mask p of a level has its parts at p * (within + 1) and after in the next."""
    out, now = [], [0]
    for _ in range(levels):
        new = []
        for mask in now:
            free = [b for b in range(64) if not mask >> b & 1]
            for k in range(within + 1):
                new.append(mask | sum(1 << b for b in free[k * len(free) // (within + 1) : (k + 1) * len(free) // (within + 1)]))
        out.append(new)
        now = new
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bucketed(spark: SparkSession, distinct: DataFrame, within: int, shard: int) -> DataFrame:
    """(level, part, bits, fp): each fingerprint in each of its buckets."""
    def dealt(rows: DataFrame, level: int, own: list[int]) -> DataFrame:
        """To the buckets of the masks below each row's part (all of them at the first level)."""
        width = within + 1
        if level == 0:
            return rows.select("fp", F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for p, m in enumerate(own)])))
        table = F.array(*[F.lit(_signed(m)) for m in own])
        parts = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.col("part") * width + k)
        return rows.select("fp", F.explode(parts).alias("part")).select("fp", "part", F.col("fp").bitwiseAND(F.get(table, F.col("part"))).alias("bits"))

    out, rows = None, distinct.select("fp")
    for level, own in enumerate(masks(within)):
        rows = dealt(rows, level, own)
        large = stage(spark, rows.groupBy("part", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > shard).drop("n"), "large_buckets", light=True) if level < LEVELS - 1 else None
        done = large is None or large.isEmpty()
        small = rows if done else rows.join(large, ["part", "bits"], "left_anti")
        small = small.select(F.lit(level).alias("level"), "part", "bits", "fp")
        out = small if out is None else out.unionByName(small)
        if done:
            break
        rows = rows.join(large, ["part", "bits"], "left_semi")
    return out


def close_pairs(key: np.ndarray, points: np.ndarray, within: int, links: Links) -> None:
    """Pairs of points with equal keys. Small runs of a key are compared shift by shift, all runs at once; longer ones by a tree each."""
    order = np.lexsort((points, key))
    key, points = key[order], points[order]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, np.int64)
    size = np.diff(cut)
    for k in np.flatnonzero(size > LEAF).tolist():
        search(points[cut[k] : cut[k + 1]], np.empty(0, np.uint64), within, links)
    few = np.repeat(size <= LEAF, size)
    key, points = key[few], points[few]
    for by in range(1, int(size[size <= LEAF].max(initial=0))):
        near = np.flatnonzero((key[by:] == key[:-by]) & (np.bitwise_count(points[by:] ^ points[:-by]) <= within))
        links.add(points[near], points[near + by])


def links_between(spark: SparkSession, distinct: DataFrame, within: int = DISTANCE, shard: int = SHARD) -> DataFrame:
    """A spanning forest (a, b) of each shard's pairs of distinct fingerprints (fp) that differ in at most `within` bits."""
    shards = max((within + 1) * distinct.count() // shard, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2, 1)
    rows = bucketed(spark, distinct, within, shard)

    def pairs(t: pa.Table) -> pa.Table:
        links = Links()
        close_pairs(np.asarray(t["key"]), np.asarray(t["fp"]).view(np.uint64), within, links)
        a, b = links.reduce()
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    # Keys are hashes of buckets: if two share one, points are compared that need not be, and no pair is lost.
    keyed = rows.select(F.xxhash64("level", "part", "bits").alias("key"), "fp").withColumn("shard", F.pmod("key", F.lit(shards)))
    return keyed.groupBy("shard").applyInArrow(pairs, "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame, within: int = DISTANCE, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document."""
    tune(spark)
    prints = stage(spark, fingerprints(docs, size, seed), "fingerprints")
    least = stage(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fp")
    roots = components(spark, links_between(spark, least, within))
    linked = roots.join(least, roots.node == least.fp)
    ids = linked.groupBy("root").agg(F.min("least").alias("component"))
    component = stage(spark, roots.join(ids, "root").select(F.col("node").alias("fp"), "component"), "components")
    of_print = least.join(component, "fp", "left").select("fp", F.coalesce("component", "least").alias("component_id"))
    return prints.join(of_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
