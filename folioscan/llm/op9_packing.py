"""Operator 9: best-fit-decreasing packing of tokenised documents into sequences.

Best-fit decreasing only looks at lengths, and lengths are whole numbers from 1 to the capacity. So the
corpus is reduced to a histogram of at most `capacity` rows; a segment tree over remaining capacities
places runs of equal pieces on the driver (bounded work, whatever the corpus size), and every piece finds
its place from its rank among the pieces of its length. Ranks come from (bucket, length) windows plus
prefix sums over buckets, so a length that a third of all pieces share is never in one task.

Defined results: a null or empty text is one piece that holds id 1 only; an empty table gives an empty
table; repeated rows are packed as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import stage, steps, table, tune

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Base symbols of the vocabulary file as bytes: the printable bytes stand for themselves, the others follow from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: Words that the fast path takes: Latin letters, whose lower case and composition are plain.
_PLAIN = re.compile("[\x01-\u024f]*").fullmatch


class WordIds:
    """Ids of texts, from the ids of their distinct space-separated parts.

    The tokenizer drops white space and never joins over it, so parts can be encoded on their own, each
    distinct one of a batch once. All go through the vocabulary and merges in one call: a NUL after each
    word stands for its end mark, merges of a pair rank as its id, and a line feed ends a part. What isn't
    plain Latin text, or has "<|" in it, goes to the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        special = {a["content"] for a in model["added_tokens"]}
        ranks = {}
        for token, i in model["model"]["vocab"].items():
            if token not in special:
                end = token.endswith("</w>") and len(token) > 4
                ranks[bytes(_BYTE_OF[c] for c in (token[:-4] if end else token)) + b"\0" * end] = i
        self.fast = tiktoken.Encoding("words", pat_str="[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
        self.stop = ranks[b"\n\0"]
        words = next(p["pattern"]["Regex"] for p in model["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.parts = regex.compile(words + "|\n").findall

    def encode(self, word: str) -> np.ndarray:
        return np.array(self.slow.encode(word, add_special_tokens=False).ids, dtype="<u4")

    def of_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts one after another, and where each part's ids start (and the last ones end)."""
        text, odd = "\n".join(parts), {}
        if not _PLAIN(text) or "<|" in text:
            odd = {i: self.encode(p) for i, p in enumerate(parts) if not _PLAIN(p) or "<|" in p}
            text = "\n".join("" if i in odd else p for i, p in enumerate(parts))
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        ids = np.array(self.fast.encode_ordinary("\0".join(self.parts(text.lower() + "\n")) + "\0"), dtype="<u4")
        stops = np.flatnonzero(ids == self.stop)
        if len(stops) != len(parts):
            raise ValueError("the vocabulary doesn't keep the ends of parts")
        ids = np.delete(ids, stops)
        starts = np.concatenate([[0], stops - np.arange(len(stops))])
        if odd:
            own = [odd.get(i, ids[starts[i] : starts[i + 1]]) for i in range(len(parts))]
            ids, starts = np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])
        return ids, starts

    def of_all(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (nulls: none), each followed by end, and where each text's ids start."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        flat = split.flatten()
        coded = pc.dictionary_encode(flat)
        ids, starts = self.of_parts(coded.dictionary.to_pylist())
        if end is not None:
            ids = np.append(ids, np.uint32(end)).astype("<u4")
        index = np.asarray(coded.indices)
        first = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(split)))])
        begin, size = starts[index], starts[index + 1] - starts[index]
        if end is not None:  # one more part after each text
            begin = np.insert(begin, first[1:], len(ids) - 1)
            size = np.insert(size, first[1:], 1)
            first = first + np.arange(len(first))
        total = np.concatenate([[0], np.cumsum(size)])
        return ids[np.repeat(begin - total[:-1], size) + np.arange(total[-1])], total[first]


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and its end id, cut only if too long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path or tokenizer_path())
        for batch in steps(batches, limit=32 << 20):
            ids, first = own.of_all(batch.column(1), END_ID)
            raw, sizes = memoryview(ids).cast("B"), np.diff(first)
            n = -(-sizes // capacity)  # pieces of each document
            doc = np.repeat(np.arange(len(sizes)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            at = 4 * (first[doc] + start)
            crc = [zlib.crc32(raw[lo:hi]) for lo, hi in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


class CapacityTree:
    """Segment tree over remaining capacities: which of them have open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.used = bytearray(2 * self.size)

    def set(self, at: int, on: bool) -> None:
        at += self.size
        self.used[at] = on
        while at > 1:
            at >>= 1
            self.used[at] = self.used[2 * at] or self.used[2 * at + 1]

    def tightest(self, least: int) -> int:
        """The smallest marked capacity of at least `least`, or -1."""
        at = least + self.size
        if self.used[at]:
            return least
        while at > 1:
            if not at & 1 and self.used[at + 1]:
                at += 1
                break
            at >>= 1
        else:
            return -1
        while at < self.size:
            at = 2 * at if self.used[2 * at] else 2 * at + 1
        return at - self.size


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over counts of lengths.

    Rows (length, first rank, last rank + 1, pieces a bin, first bin, offset): the pieces of one length
    from rank to rank go into bins that follow one another, `pieces a bin` into each from `offset` on.
    Bins with the same history stay a range of numbers, so no step depends on the number of pieces.
    """
    tree, open_bins, runs, bins = CapacityTree(capacity), {}, [], 0

    def give(room: int, first: int, n: int) -> None:
        if n > 0 and room > 0:
            open_bins.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room < 0:
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    tree.set(room, False)
            each = room // length
            full, rest = (n, 0) if left >= n * each else divmod(left, each)
            if full:
                runs.append((length, rank, rank + full * each, each, first, capacity - room))
                give(room - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if rest:
                runs.append((length, rank, rank + rest, rest, first + full, capacity - room))
                give(room - rest * length, first + full, 1)
                rank, left = rank + rest, left - rest
            give(room, first + full + (rest > 0), n - full - (rest > 0))
    return np.array(runs, dtype=np.int64).reshape(-1, 6)


def pack_pieces(spark: SparkSession, cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """cut (a staged table of pieces) with sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs = spark.sparkContext.broadcast(plan(counts, capacity))  # some runs a length, whatever the number of pieces
    n_buckets = max(16, sum(counts.values()) // 100_000)
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_buckets)).cast("int"))
    # The count of a bucket's pieces stands beside each of them, so no second pass joins it back.
    own = Window.partitionBy("bucket", "length")
    ranked = dealt.withColumn("r", F.row_number().over(own.orderBy("doc_id", "piece", "ids_crc32")))
    before = dealt.groupBy("bucket", "length").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = ranked.join(before.select("bucket", "length", F.coalesce("before", F.lit(0)).alias("before")), ["bucket", "length"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, wide = runs.value, 1 << 44
        order = np.lexsort((own[:, 1], own[:, 0]))
        own = own[order]
        keys = own[:, 0] * wide + own[:, 1]
        for batch in batches:
            length, rank = (np.asarray(batch.column(i)) for i in (3, 5))
            at = np.searchsorted(keys, length * wide + rank, side="right") - 1
            j, each = rank - own[at, 1], own[at, 3]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(own[at, 4] + j // each), pa.array(own[at, 5] + (j % each) * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("r") - 1).alias("rank")).mapInArrow(place, PIECES + ", sequence_id long, offset long")


def pack_documents(spark: SparkSession, docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    tune(spark)
    return pack_pieces(spark, stage(spark, pieces(docs, path, capacity), "pieces"), capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"))
