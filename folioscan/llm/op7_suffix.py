"""Operator 7: removal of long repeated byte strings with a logarithmic family of sparse, hash-ordered suffix arrays.

A departure from the method as named: the levels do not hold suffix arrays of whole texts in the order of their bytes, but entries for the suffixes
at sampled anchors only, in the order of hashes of bounded stretches (about one entry in thirty bytes). All else is kept: new batches are sorted, merge-scanned
against the levels, and levels of equal size merge.

A byte goes if a string of `length` bytes around it also starts earlier (a smaller doc_id, or the same
document further left). Only suffixes at anchors are indexed: the least of all k-gram hashes in a window of
`length` bytes is a function of the window's bytes, so equal windows have their anchor at the same place. The
windows that share an anchor make up one stretch of text.

1. Map tasks cut texts into stretches and send their 64-bit keys, packed, to buckets; about a million stretches
   of a task are gathered and their repeats settled at once, so a passage in a third of all texts sends an entry
   or a few a task, and a task sends a bucket one payload or a few, however large the table is.
2. Each bucket's logarithmic index family keeps the earliest of equal stretches; the others are covered whole.
3. Where the same anchor k-gram is in several different stretches (the edges of repeats), the stretches are
   taken apart into their single windows, which meet in the same way.
4. Covered parts are gathered by document and cut out. They, and the edges of 3, go packed to blocks of documents first.

An order by the hash of a suffix's first bytes serves for the suffix arrays: only equality over a bounded length is
asked for, and any order of such prefixes brings equal ones together. Hashes with random byte values stand
for byte equality: of a stretch 64 bits of its own and the 48 of its anchor's k-gram, which equal stretches share; of a single window 64 bits
and 16 of a second hash. (At 100 TB some 15 of 6e12 windows may be taken for equal by chance; with 64 bits it would be a million.)

Defined results: a null text is empty; a text shorter than `length` loses nothing; rows that repeat a doc_id
count as that one document (none is earlier than the other) and each gets a result row; rows without a
doc_id count as one document before all others, and lose nothing; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import NO_ID, buckets, columns_of, discard, first_of, forget, mix, stage, steps, table, tune
from ._levels import COVER, COVERED, PARTS, Levels, Rows, blocks, by_bucket, by_document, covered, dealt, joined, put_together, with_payloads

LENGTH = 100
GRAM = 32
#: Row kinds besides covered parts: stretches by bucket, grams by block, edge stretches by block of documents and then by document, windows by bucket.
STRETCH, GRAMS, EDGE, WINDOW = range(1, 5)
STRETCHES = ["<u8", "<i8", "<i4", "<u8", "<i2", "<i2"]  # key, doc, pos, gram, first and last window relative to pos
GRAM_ROWS = ["<u8", "<i8", "<i4", "<i2", "<i2"]
WINDOWS = ["<u8", "<i8", "<i4", "<u2"]  # key, doc, pos, check
EDGES = np.dtype([("pos", "<i4"), ("lo", "<i2"), ("hi", "<i2")])
EDGE_ROWS = ["<i8", "<i4", "<i2", "<i2"]  # doc, pos, first and last window
#: Bits of a gram's hash: it only says where to look closer.
GRAM_BITS = np.uint64((1 << 48) - 1)
#: Buckets' worth of grams that one task holds: they are the larger part of what buckets find.
GRAM_BUCKETS = 4
#: Windows whose anchors are found at a time: what that takes stays in the cache.
BLOCK = 1 << 14
#: Bytes of text that are hashed at a time: that takes some 60 times as much memory. Powers of the base that are kept for the next.
OWN_STEP, KEPT_POWERS = 1 << 19, 1 << 20
_UPPER, _PLACES = np.uint64(0xFFFFFFFF << 32), np.arange(1 << 15, dtype=np.uint64)

_rng = np.random.default_rng(20250601)
_VALUE, _VALUE2 = _rng.integers(1, 2**64, (2, 256), dtype=np.uint64)
_BASE = int(_rng.integers(1, 2**62)) * 2 + 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64; those of a longer text than usual are not kept."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    size = max(n, min(1 << (n - 1).bit_length(), KEPT_POWERS))
    found = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(size, b, np.uint64)
        x[0] = 1
        found.append(np.multiply.accumulate(x, out=x))
    if size <= KEPT_POWERS:
        _POWERS[:] = found
    return found[0][:n], found[1][:n]


class Hashed:
    """Bytes whose substrings' hashes take constant time."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.data, self.up = data, up[: len(data)]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[data] * self.up, out=self.sums[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return mix((self.sums[start + size] - self.sums[start]) * self.down[start])

    def check(self, start: np.ndarray, size) -> np.ndarray:
        """The upper 16 bits of a hash with other byte values."""
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_VALUE2[self.data] * self.up, out=sums[1:])
        return (mix((sums[start + size] - sums[start]) * self.down[start]) >> np.uint64(48)).astype("<u2")

    def anchors(self, length: int, gram: int) -> np.ndarray:
        """Of every window of `length` bytes: where its least gram (by the upper 32 bits of a hash; the leftmost of equals) starts."""
        n, width = len(self.data) - length + 1, length - gram + 1
        out, block = np.empty(n, np.int64), max(BLOCK, len(_PLACES) - width + 1)
        places = _PLACES if block + width - 1 <= len(_PLACES) else np.arange(block + width - 1, dtype=np.uint64)
        for a in range(0, n, block):
            b = min(a + block, n)
            end = b + width - 1
            best, span = (self.sums[a + gram : end + gram] - self.sums[a:end]) * self.down[a:end], 1
            best &= _UPPER
            best |= places[: end - a]
            while span < width:
                step = min(span, width - span)
                best = np.minimum(best[:-step], best[step:])
                span += step
            out[a:b] = (best & ~_UPPER).view(np.int64)
            out[a:b] += a
        return out


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each starts."""
    data = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    return np.frombuffer(b"".join(data), np.uint8), starts


def stretches(data: np.ndarray, starts: np.ndarray, docs: np.ndarray, length: int, gram: int) -> list[np.ndarray]:
    """STRETCHES columns: for each anchor the key of the stretch that its windows cover."""
    if len(data) < length:
        return [np.empty(0, d) for d in STRETCHES]
    hashed = Hashed(data)
    anchor = hashed.anchors(length, gram)
    # Windows of one anchor follow one another; a run also ends where windows reach into the next document.
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    has = np.diff(starts) >= length
    new[starts[:-1][has]] = True
    beyond = starts[1:][has] - length + 1
    new[beyond[beyond < len(new)]] = True
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(new)) - 1
    doc = np.searchsorted(starts, lo, side="right") - 1
    inside = lo + length <= starts[doc + 1]
    lo, hi, doc = lo[inside], hi[inside], doc[inside]
    at = anchor[lo]
    key = hashed.of(lo, hi - lo + length)
    key = mix(key ^ ((at - lo).astype(np.uint64) << np.uint64(20)) ^ (hi - lo + 1).astype(np.uint64))
    return [key, docs[doc], (at - starts[doc]).astype("<i4"), hashed.of(at, gram) & GRAM_BITS, (lo - at).astype("<i2"), (hi - at).astype("<i2")]


def edge_rows(rows: Rows, doc: np.ndarray, *columns: np.ndarray) -> None:
    """EDGE rows: the stretches of each document that are taken apart."""
    data = np.empty(len(doc), EDGES)
    for name, column in zip(EDGES.names, columns, strict=True):
        data[name] = column
    rows.records(EDGE, doc, data)


def edge_windows(batch: pa.RecordBatch, length: int) -> list[np.ndarray]:
    """WINDOWS columns: every window of the edge stretches that the payloads of each text name."""
    data, starts = _joined(batch.column(1))
    if len(data) < length:
        return [np.empty(0, d) for d in WINDOWS]
    hashed, ids = Hashed(data), np.asarray(batch.column(0).fill_null(NO_ID))
    own = [b"".join(p or []) for p in batch.column(2).to_pylist()]
    edges = np.frombuffer(b"".join(own), EDGES)
    size = edges["hi"].astype(np.int64) - edges["lo"] + 1
    doc = np.repeat(np.repeat(np.arange(len(own)), [len(p) // EDGES.itemsize for p in own]), size)
    at = np.repeat(edges["pos"].astype(np.int64) + edges["lo"], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    fits = at + length <= starts[doc + 1] - starts[doc]  # always, unless rows with one doc_id have different texts
    doc, at = doc[fits], at[fits]
    return [hashed.of(starts[doc] + at, length), ids[doc], at.astype("<i4"), hashed.check(starts[doc] + at, length)]


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def repeated_parts(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows (kind, key = doc_id, payload): packed [start, end) bytes that an earlier string of `length` bytes covers."""
    tune(spark)
    n = np.uint64(buckets(spark, docs))
    m, of_grams = blocks(int(n)), np.uint64(blocks(int(n), GRAM_BUCKETS))
    docs = _docs(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (stretches(*_joined(b.column(1)), np.asarray(b.column(0).fill_null(NO_ID)), length, gram) for b in steps(batches, limit=OWN_STEP))
        yield from dealt(found, first_stretches)

    def first_stretches(own: list[np.ndarray]) -> Rows:
        first, later = first_of(*own[:4])
        rows = Rows()
        rows.to_blocks(COVERED, m, *joined(own[1][later], own[2][later] + own[4][later], own[2][later] + own[5][later] + length))
        first.sort()
        own[:] = [own.pop(0)[first] for _ in STRETCHES]
        rows.add(STRETCH, (own[0] % n).astype(np.int64), own)
        return rows

    def earliest(payloads: Iterator[bytes], rows: Rows) -> None:
        levels = Levels(STRETCHES)
        lost = [[c[1], c[2] + c[4], c[2] + c[5] + length] for c in levels.take(payloads)]
        if lost:
            rows.to_blocks(COVERED, m, *joined(*put_together(lost)))
        _, doc, pos, g, lo, hi = levels.all()
        # One of each gram goes on to meet those of other buckets; the others are known to be edges, and make it one as well.
        order = np.argsort(g)
        new = np.ones(len(g), bool)
        new[1:] = g[order][1:] != g[order][:-1]
        several = np.zeros(len(g), bool)
        several[:-1] = ~new[1:]
        several |= ~new
        edge, single = order[several], order[new & ~several]
        both = order[new & several]
        rows.to_blocks(EDGE, m, doc[edge], pos[edge], lo[edge], hi[edge])
        out = np.concatenate([single, both])
        mark = np.concatenate([lo[single], np.full(len(both), 1, "<i2")])  # 1: this one is an edge already
        rows.add(GRAMS, (g[out] % of_grams).astype(np.int64), [g[out], doc[out], pos[out], mark, hi[out]])

    met = stage(spark, by_bucket(docs.mapInArrow(cut, COVER), int(n), earliest), "earliest")

    def shared(t: pa.Table) -> pa.Table:
        cols = [columns_of(p.as_py(), GRAM_ROWS) for p in t["payload"]]
        g, doc, pos, lo, hi = (np.concatenate(c) for c in zip(*cols, strict=True))
        order = np.argsort(g)
        new = np.ones(len(g), bool)
        new[1:] = g[order][1:] != g[order][:-1]
        several = ~new
        several[:-1] |= ~new[1:]
        edge = order[several]
        edge = edge[lo[edge] != 1]
        rows = Rows()
        rows.to_blocks(EDGE, m, doc[edge], pos[edge], lo[edge], hi[edge])
        return rows.table()

    # Edges and covered parts are small; grams go as soon as both are written.
    edges = stage(spark, met.filter(f"kind = {EDGE}").union(met.filter(f"kind = {GRAMS}").groupBy("key").applyInArrow(shared, COVER)), "edges")
    found = stage(spark, met.filter(f"kind = {COVERED}"), "covered")
    discard(spark, met)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from dealt((edge_windows(b, length) for b in steps(batches, limit=OWN_STEP)), first_windows)

    def first_windows(own: list[np.ndarray]) -> Rows:
        first, later = first_of(*own)
        rows = Rows()
        rows.to_blocks(COVERED, m, *joined(own[1][later], own[2][later], own[2][later] + length))
        first.sort()
        own[:] = [own.pop(0)[first] for _ in WINDOWS]
        rows.add(WINDOW, (own[0] % n).astype(np.int64), own)
        return rows

    texts = with_payloads(docs, by_document(edges, EDGE_ROWS, edge_rows)).filter("payloads is not null")

    def earliest_window(payloads: Iterator[bytes], rows: Rows) -> None:
        lost = [[c[1], c[2], c[2] + length] for c in Levels(WINDOWS).take(payloads)]
        if lost:
            rows.to_blocks(COVERED, m, *joined(*put_together(lost)))

    last = stage(spark, by_bucket(texts.mapInArrow(windows, COVER), int(n), earliest_window), "windows")
    discard(spark, edges)
    return by_document(found.union(last), PARTS, lambda rows, *parts: rows.cover(COVERED, *parts))


def kept_parts(data: bytes, payloads: list[bytes] | None) -> tuple[list[bytes], int, int]:
    """The remaining pieces of a text, how many bytes went, and in how many maximal runs."""
    start, end = covered(payloads, len(data))
    if not len(start):
        return [data], 0, 0
    edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(data)]
    return [data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)], int((end - start).sum()), len(start)


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with text and n_chars of what stays; a character that a cut went through goes whole. Other columns stay as they are."""
    names, schema = docs.columns, docs.schema
    rows = repeated_parts(spark, docs, length)
    forget(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            row, kept = batch.column(3), []
            for t, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                kept.append(t if t is None or not p else b"".join(kept_parts(t.encode("utf-8", "surrogatepass"), p)[0]).decode("utf-8", "ignore"))
            columns = dict(zip(names, row.flatten(), strict=True))
            columns["text"] = pa.array(kept, pa.string())
            if "n_chars" in columns:
                columns["n_chars"] = pc.utf8_length(columns["text"]).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return with_payloads(own, rows, "row").mapInArrow(run, schema)


def digest(spark: SparkSession, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = []
            for t, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (t or "").encode("utf-8", "surrogatepass")
                parts, gone, spans = kept_parts(data, p)
                rows.append((len(data), gone, spans, hashlib.sha256(b"".join(parts)).hexdigest()))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = repeated_parts(spark, docs, length)
    forget(spark)
    return with_payloads(_docs(docs), rows).mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(spark, table(spark, sf_dir, "documents"))
