"""Operator 1: removal of sentence spans that repeat anywhere in the corpus.

Every run of `size` consecutive sentences is hashed (case and white space folded), however short they are; so are shorter runs
that are long in words, and the whole of a text with fewer sentences. Characters of scripts without spaces count as a word each. Runs meet by key over all documents: map
tasks settle repeats among their own texts and send one entry a key, packed, to the key's bucket, where the
earliest (smallest doc_id, then position) stays. A sentence that any other run covers is removed.

Defined results: null and empty texts, and texts of white space, have no sentences and stay as they are (null: empty);
of exact copies only the one with the smallest doc_id stays whole; rows that repeat a doc_id count as that one
document, and each gets a result row; rows without a doc_id count as one document before all others, and lose nothing; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import NO_ID, buckets, columns_of, first_of, forget, mix, stage, steps, table, tune
from ._levels import COVER, COVERED, Levels, Rows, by_bucket, covered, with_payloads

#: Sentences in a run.
SIZE = 3
#: Words that a run of so many sentences must have: all full runs count, but one or two short sentences repeat by chance.
LEAST_WORDS = {3: 1, 2: 25, 1: 50}
RUN = 1
RUNS = ["<u8", "<i8", "<i4", "<u4", "<i2"]  # key, doc, first sentence, check, sentences

_chunks = re.compile(r"[^.!?。！？\n]*(?:[.!?。！？]+[^\S\n]*\n*|\n+)|[^.!?。！？\n]+").findall
#: Thai to Myanmar, Khmer, kana, Han.
_unspaced = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]").findall
_K, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def sentences(text: str) -> tuple[list[str], list[str]]:
    """Sentences with what parts them (together they are the text), and their folded forms."""
    own, folded = [], []
    for chunk in _chunks(text):
        words = chunk.split()
        if words or not own:
            own.append(chunk)
            folded.append(" ".join(words).casefold())
        else:
            own[-1] += chunk
    if folded and not folded[0]:  # white space at the start goes with the first sentence
        if len(own) > 1:
            own[1] = own[0] + own[1]
        own, folded = own[1:], folded[1:]
    return own, folded


def n_words(folded: str) -> int:
    """Words parted by spaces, or characters of a script that has none, whichever are more."""
    spaced = folded.count(" ") + 1
    return spaced if folded.isascii() else max(spaced, len(_unspaced(folded)))


def runs_of(folded: list[str], size: int = SIZE, least: dict[int, int] | None = None) -> list[np.ndarray]:
    """(key, first sentence, check, sentences) of the runs of one text: 64 and 32 bits of two independent hashes stand for its words."""
    n, least = len(folded), least or LEAST_WORDS
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s) for s in folded], np.uint64)
    h2 = np.array([digest(s, 2) for s in folded], np.uint64)
    words = np.array([n_words(s) for s in folded], np.int64)
    total = np.concatenate([[0], np.cumsum(words)])
    keys, first, checks, sizes = [], [], [], []
    for k in range(1, size + 1):
        if n < k:
            break
        key, check = h[: n - k + 1].copy(), h2[: n - k + 1].copy()
        for i in range(1, k):
            key = key * _K + h[i : n - k + 1 + i]
            check = check * _K2 + h2[i : n - k + 1 + i]
        at = np.flatnonzero(total[k:] - total[: n - k + 1] >= least.get(k, 0))
        keys.append(mix(key[at] ^ np.uint64(k)))
        first.append(at)
        checks.append((mix(check[at]) >> np.uint64(32)).astype("<u4"))
        sizes.append(np.full(len(at), k, "<i2"))
    if 0 < n < size:
        keys.append(np.array([digest("\n".join(folded), 1)], np.uint64))
        first.append(np.zeros(1, np.int64))
        checks.append(np.array([digest("\n".join(folded), 3) >> 32], "<u4"))
        sizes.append(np.full(1, n, "<i2"))
    return [np.concatenate(x) if x else np.empty(0, d) for x, d in ((keys, np.uint64), (first, np.int64), (checks, "<u4"), (sizes, "<i2"))]


def repeated_sentences(spark: SparkSession, docs: DataFrame, size: int = SIZE, least: dict[int, int] | None = None) -> DataFrame:
    """Rows (kind, key = doc_id, payload): packed [start, end) sentences that a non-first repeated run covers."""
    tune(spark)
    n = np.uint64(buckets(spark, docs))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = [(i, runs_of(sentences(t)[1], size, least)) for i, t in zip(batch.column(0).fill_null(NO_ID).to_pylist(), batch.column(1).to_pylist(), strict=True) if t]
            if not found:
                continue
            key, first, checks, sizes = (np.concatenate([f[k] for _, f in found]) for k in range(4))
            own = [key, np.repeat(np.array([i for i, _ in found], np.int64), [len(f[0]) for _, f in found]), first.astype("<i4"), checks, sizes]
            kept, later = first_of(*own[:4])
            rows, lost = Rows(), [c[later] for c in own]
            rows.cover(COVERED, lost[1], lost[2], lost[2] + lost[4])
            own = [c[np.sort(kept)] for c in own]
            rows.add(RUN, (own[0] % n).astype(np.int64), own)
            yield rows.batch()

    def earliest(payloads: Iterator[bytes], rows: Rows) -> None:
        levels = Levels(RUNS)
        for p in payloads:
            lost = levels.add(columns_of(p, RUNS))
            rows.cover(COVERED, lost[1], lost[2], lost[2] + lost[4])

    return stage(spark, by_bucket(_docs(docs).mapInArrow(cut, COVER), int(n), earliest), "repeated_runs")


def _docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def remove_spans(spark: SparkSession, docs: DataFrame, size: int = SIZE, least: dict[int, int] | None = None) -> DataFrame:
    """(doc_id, n_sentences, n_removed, n_spans, n_removed_chars, text): each document without its repeated spans."""
    out = "doc_id long, n_sentences long, n_removed long, n_spans long, n_removed_chars long, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = []
            for t, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = sentences(t or "")[0]
                start, end = covered(p, len(own))
                if len(start):
                    edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(own)]
                    kept = "".join("".join(own[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True))
                else:
                    kept = t or ""
                rows.append((len(own), int((end - start).sum()), len(start), len(t or "") - len(kept), kept))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())], names=["doc_id", "n_sentences", "n_removed", "n_spans", "n_removed_chars", "text"])

    rows = repeated_sentences(spark, docs, size, least)
    forget(spark)
    return with_payloads(_docs(docs), rows).mapInArrow(run, out)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_spans(spark, table(spark, sf_dir, "documents"))
