"""A logarithmic index family over packed keys, and the coverage tables that its matches fill.

Map tasks send packed columns (key, doc, pos, check, ...) dealt to buckets by key. A bucket's task puts payloads
together to batches of bounded size (their number grows with the map tasks, their size shrinks with the number of
buckets) and takes the batches one by one: each is sorted (a suffix array, where keys stand for suffixes of bounded length), merge-
scanned against the levels that are there, and kept as a new lowest level; levels of equal size class merge,
so each entry moves a logarithmic number of times. Of equal keys the earliest (doc, pos) stays; the others
are reported.

What buckets find of one document comes from many of them. They send it packed to blocks of documents, and each block's
task makes one row a document of it: a row for each document and bucket would be all but a row for each part once
there are more buckets than a document has parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import columns_of, first_of, give_back, merged, mix, packed_by, slices

#: Rows of a coverage table: document, starts and ends (int32 each, in pairs) of the parts that are covered.
COVER = "kind int, key long, payload binary"
PART = np.dtype([("start", "<i4"), ("end", "<i4")])
#: Columns of covered parts on their way to a block of documents.
PARTS = ["<i8", "<i4", "<i4"]
#: Blocks that there are, if there are so many buckets; beyond, buckets' worth of covered parts (or as many bytes) that a block takes.
BLOCKS, BLOCK_BUCKETS = 64, 16
#: Rows that a batch of the levels has at least, if there are so many; rows that a map task gathers before it deals them out.
BATCH, GATHER = 1 << 16, 1 << 20


class Levels:
    """Sorted runs of (key, doc, pos, check, ...), of sizes that double."""

    def __init__(self, dtypes: list[str]):
        self.dtypes, self.runs = dtypes, []

    def add(self, batch: list[np.ndarray]) -> list[np.ndarray]:
        """Take a batch; return the rows (of it, or of levels) that have an earlier equal key."""
        first, later = first_of(*batch[:4])
        lost = [[c[later] for c in batch]]
        run = [c[first] for c in batch]
        for i, level in enumerate(self.runs):
            at = np.searchsorted(level[0], run[0])
            at[at == len(level[0])] = 0
            same = (level[0][at] == run[0]) & (level[3][at] == run[3]) if len(level[0]) else np.zeros(len(run[0]), bool)
            if not same.any():
                continue
            mine, theirs = np.flatnonzero(same), at[same]
            d, p, e, q = run[1][mine], run[2][mine], level[1][theirs], level[2][theirs]
            older = (e < d) | ((e == d) & (q <= p))
            equal = (e == d) & (q == p)
            lost.append([c[mine[older & ~equal]] for c in run])
            lost.append([c[theirs[~older]] for c in level])
            # The earlier entry stays: in the new run if it is newly found, else where it was.
            keep = np.ones(len(run[0]), bool)
            keep[mine[older]] = False
            run = [c[keep] for c in run]
            stay = np.ones(len(level[0]), bool)
            stay[theirs[~older]] = False
            self.runs[i] = [c[stay] for c in level]
        self.runs.append(run)
        while len(self.runs) > 1 and len(self.runs[-2][0]) <= 2 * len(self.runs[-1][0]):
            a, b = self.runs.pop(), self.runs.pop()
            both = [np.concatenate(x) for x in zip(a, b, strict=True)]
            order = np.argsort(both[0], kind="stable")  # two sorted runs: the sort merges them
            self.runs.append([c[order] for c in both])
        return [np.concatenate(x) for x in zip(*lost, strict=True)]

    def take(self, payloads: Iterator[bytes]) -> Iterator[list[np.ndarray]]:
        """Add packed rows, BATCH or more at a time; what add() returns."""
        for batch in gathered((columns_of(p, self.dtypes) for p in payloads), BATCH):
            yield self.add(batch)

    def all(self) -> list[np.ndarray]:
        parts = [list(x) for x in zip(*self.runs, strict=True)] or [[] for _ in self.dtypes]
        return [np.concatenate([np.empty(0, d), *p]) for d, p in zip(self.dtypes, parts, strict=True)]


def put_together(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The columns of all parts, one part after another; each part's columns go as they are copied, and parts is empty afterwards."""
    out = [np.concatenate([columns.pop(0) for columns in parts]) for _ in range(len(parts[0]))]
    parts.clear()
    return out


def gathered(parts: Iterator[list[np.ndarray]], least: int) -> Iterator[list[np.ndarray]]:
    """Columns put together until they have `least` rows; the last may have fewer. Whoever takes them should let go of them before asking for more."""
    held, n = [], 0
    for columns in parts:
        held.append(columns)
        n += len(columns[0])
        if n >= least:
            yield put_together(held)
            n = 0
    if n:
        yield put_together(held)


def joined(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered parts, joined where they touch or overlap, by document."""
    docs, rank = np.unique(doc, return_inverse=True)
    # The parts of each document in a range of their own: no two documents touch.
    base = rank.astype(np.int64) << 32
    start, end = merged(base + start, base + end)
    return docs[start >> 32], (start & 0xFFFFFFFF).astype("<i4"), (end & 0xFFFFFFFF).astype("<i4")


def blocks(buckets: int, most: int = BLOCK_BUCKETS) -> int:
    """How many blocks take what buckets have found: a bucket sends a row or a few to each, and a block's task holds what about `most` buckets found, or fewer."""
    return max(min(buckets, BLOCKS), buckets // most)


class Rows:
    """Rows (kind, key, payload) in the making."""

    def __init__(self):
        self.parts = [(np.empty(0, np.int32), np.empty(0, np.int64), pa.array([], pa.binary()))]

    def _put(self, kind: int, keys, payloads: pa.Array) -> None:
        self.parts.append((np.full(len(payloads), kind, np.int32), np.asarray(keys, np.int64), payloads))

    def add(self, kind: int, key: np.ndarray, arrays: list[np.ndarray]) -> None:
        """For few keys of many rows each: packed columns. arrays is empty afterwards."""
        self._put(kind, *packed_by(key, arrays))

    def records(self, kind: int, key: np.ndarray, data: np.ndarray) -> None:
        """For many keys of few rows each, without a step for each: the records of a key one after another."""
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
        ends = (np.append(first, len(key)) * data.dtype.itemsize).astype("<i4")
        self._put(kind, key[first], pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data[order].tobytes())]))

    def cover(self, kind: int, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Covered parts, joined, by document."""
        doc, start, end = joined(doc, start, end)
        data = np.empty(len(start), PART)
        data["start"], data["end"] = start, end
        self.records(kind, doc, data)

    def to_blocks(self, kind: int, blocks: int, doc: np.ndarray, *columns: np.ndarray) -> None:
        """Packed columns by block of documents, for by_document()."""
        doc = np.asarray(doc, np.int64)
        self.add(kind, (mix(doc.view(np.uint64)) % np.uint64(blocks)).astype(np.int64), [doc, *columns])

    def columns(self) -> dict:
        kinds, keys, payloads = zip(*self.parts, strict=True)
        return {"kind": pa.array(np.concatenate(kinds)), "key": pa.array(np.concatenate(keys)), "payload": pa.concat_arrays(payloads)}

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(self.columns())

    def table(self) -> pa.Table:
        return pa.table(self.columns())

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The rows in batches of a bounded size: the JVM holds each whole, outside its heap."""
        for kinds, keys, payloads in self.parts:
            yield from slices(pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(keys), payloads], names=["kind", "key", "payload"]), "payload")


def dealt(parts: Iterator[list[np.ndarray]], settle) -> Iterator[pa.RecordBatch]:
    """Of a map task: the rows that settle(columns) makes of GATHER or more rows at a time.

    What that takes is freed before the next rows are gathered, and at the end.
    """
    for own in gathered(parts, GATHER):
        rows = settle(own)
        del own
        yield from rows.batches()
        del rows
        give_back()


def covered(payloads: list[bytes] | None, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The joined covered parts of one text of `length` units, cut to it."""
    parts = np.frombuffer(b"".join(payloads or []), PART)
    if not len(parts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, end = merged(parts["start"].astype(np.int64), parts["end"].astype(np.int64))
    end = np.minimum(end, length)
    keep = start < end
    return start[keep], end[keep]


#: Kind of the rows that say what is covered, in every table of rows.
COVERED = 0


def by_bucket(rows: DataFrame, buckets: int, settle) -> DataFrame:
    """Rows of covered parts, and those that settle(payloads, rows) makes of all the other payloads of a bucket.

    Covered parts that map tasks have found already go through the same exchange, so nothing is computed twice.
    """

    def run(t: pa.Table) -> pa.Table:
        out, ready = Rows(), pc.equal(t["kind"], COVERED)
        settle((p.as_py() for p in t["payload"].filter(pc.invert(ready))), out)
        give_back()
        return pa.concat_tables([t.select(["kind", "key", "payload"]).filter(ready), out.table()])

    bucket = F.when(F.col("kind") == COVERED, F.pmod(F.xxhash64("key"), F.lit(buckets))).otherwise(F.col("key"))
    dealt = rows.withColumn("bucket", bucket)
    # Where there are more buckets than shuffle partitions, each is a partition of its own: one is held in memory at a time in any case.
    if buckets > 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartition(buckets, "bucket")
    return dealt.groupBy("bucket").applyInArrow(run, COVER)


def by_document(rows: DataFrame, dtypes: list[str], settle) -> DataFrame:
    """Rows by document that settle(rows, *columns) makes of all the payloads of a block."""

    def run(t: pa.Table) -> pa.Table:
        out = Rows()
        settle(out, *put_together([columns_of(p.as_py(), dtypes) for p in t["payload"]]))
        give_back()
        return out.table()

    return rows.groupBy("key").applyInArrow(run, COVER)


def with_payloads(docs: DataFrame, rows: DataFrame, *more: str) -> DataFrame:
    """docs (doc_id, text and more) with the list of their rows' payloads; texts cross the join once and are not sorted."""
    lists = rows.groupBy("key").agg(F.collect_list("payload").alias("payloads"))
    return docs.join(lists.hint("shuffle_hash"), docs.doc_id == lists.key, "left").select("doc_id", "text", "payloads", *more)
