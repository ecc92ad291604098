"""What the training-data operators share: staging, Arrow batching, words, packed keys."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import uuid
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: The ASCII white space that separates words in every contract: space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that one vectorised step works on.
STEP = 2 << 20
#: Bytes of input files whose keys one bucket takes.
BUCKET_BYTES = 8 << 20
#: Rows that a packed payload has at most: the JVM takes each as one array, and large ones break up its heap.
PAYLOAD = 1 << 13
#: Where staged tables go when no shared folder is configured (local mode, tests).
LOCAL_STAGE = "/tmp/checkpoints"

#: Stands for a null doc_id where ids are compared: before all others.
NO_ID = -(1 << 63)
#: The folder that the package is in.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_find_us(spark: SparkSession) -> None:
    """Python workers import this package by name; let them look where the driver found it."""
    known = spark.sparkContext.environment
    if ROOT not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; one that is read in so few tasks that most cores would idle is dealt out first (never so with many files)."""
    workers_find_us(spark)
    df, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    few = name in ("documents", "pages") and 2 * df._jdf.queryExecution().toRdd().getNumPartitions() <= cores
    return df.repartition(cores) if few else df


def tune(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch: texts can be long, and a batch is held whole on both sides."""
    workers_find_us(spark)
    with contextlib.suppress(Exception):
        if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 2000:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a default."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"file://{LOCAL_STAGE}"


_staged: list[tuple[SparkSession, str]] = []
_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Delete every table that stage() wrote; call it when no result that reads them is needed any more."""
    while _staged:
        _delete(*_staged.pop())


def _at_exit() -> None:
    for spark, path in _staged:
        if getattr(spark.sparkContext, "_jsc", None) is not None:
            _delete(spark, path)


atexit.register(_at_exit)


def forget(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of jobs whose results are no longer referred to."""
    for _ in range(2):  # the first round lets go of plans, the second of what they held
        gc.collect()
        with contextlib.suppress(Exception):
            spark.sparkContext._jvm.System.gc()


def stage(spark: SparkSession, df: DataFrame, name: str, light: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, a lost executor costs one task.

    Shuffle files of earlier jobs are dropped first: their results are tables by now. Not so if light: for small tables in a loop.
    """
    if not light:
        forget(spark)
    path = f"{shared_dir(spark)}/folioscan/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _staged.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    _path_of[out] = path
    return out


def discard(spark: SparkSession, staged: DataFrame) -> None:
    """Delete a table that stage() wrote; nothing that reads it may run any more."""
    path = _path_of.pop(staged)
    _staged.remove((spark, path))
    _delete(spark, path)


def buckets(spark: SparkSession, rows: DataFrame, least: int = 24) -> int:
    """How many buckets packed keys are dealt to: as the size of the files that rows are read from says, and no fewer than twice the shuffle width."""
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # A plan whose size Spark doesn't know claims the most there is.
    return max(least, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES if size < 1 << 60 else 0)


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = STEP) -> Iterator[pa.RecordBatch]:
    """Slices of a task's Arrow batches of about limit bytes of column each; a longer single row stays whole. What they took goes back at the end."""
    for batch in batches:
        yield from slices(batch, column, limit)
        del batch
    give_back()


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = STEP) -> Iterator[pa.RecordBatch]:
    """Slices of about limit bytes of column each; a longer single row stays whole."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    total = np.cumsum(size)
    lo = 0
    while lo < len(size):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def columns_of(raw: bytes, dtypes: list[str]) -> list[np.ndarray]:
    """Arrays that pack() put into one payload, of one common length."""
    sizes = [np.dtype(d).itemsize for d in dtypes]
    n, at, out = len(raw) // sum(sizes), 0, []
    for d, size in zip(dtypes, sizes, strict=True):
        planes = np.frombuffer(raw, np.uint8, size * n, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).view(d).ravel())
        at += size * n
    return out


def pack(*arrays: np.ndarray) -> bytes:
    """Column after column, and in each the first bytes of all values, the second bytes and so on: ids and positions compress well so."""
    return b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() for a in arrays)


def packed_by(key: np.ndarray, arrays: list[np.ndarray], most: int = PAYLOAD) -> tuple[list[int], pa.Array]:
    """The rows of arrays by equal key, as pack() puts them, `most` rows at most in a payload: the key of each payload, and the payloads.

    They are put where Arrow has them, and each array goes as soon as it is in order: arrays is empty afterwards.
    """
    if not len(key):
        return [], pa.array([], pa.binary())
    order = np.argsort(key.astype(np.uint16) if 0 <= key.min() and key.max() < 1 << 16 else key, kind="stable")  # 16 bits sort by radix
    key = key[order]
    cut = np.flatnonzero(np.diff(key)) + 1
    runs = zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True)
    bounds = [(a, min(a + most, hi)) for lo, hi in runs for a in range(lo, hi, most)]
    sorted_ = [arrays.pop(0)[order] for _ in range(len(arrays))]
    del order
    data, ends, at = np.empty(len(key) * sum(a.itemsize for a in sorted_), np.uint8), [0], 0
    for lo, hi in bounds:
        for a in sorted_:
            size = a.itemsize * (hi - lo)
            data[at : at + size].reshape(a.itemsize, hi - lo)[:] = a[lo:hi].view(np.uint8).reshape(hi - lo, a.itemsize).T
            at += size
        ends.append(at)
    return key[[lo for lo, _ in bounds]].tolist(), pa.Array.from_buffers(pa.binary(), len(bounds), [None, pa.py_buffer(np.array(ends, "<i4")), pa.py_buffer(data)])


def give_back() -> None:
    """Hand freed memory back to the system: Python workers outlive their tasks, and each would keep what its largest step took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(Exception):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def first_of(key: np.ndarray, doc: np.ndarray, pos: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the first (doc, pos) of each key, and of the rows that have an earlier one.

    Keys are equal if their checks are too: rows of different checks that share a key part where they meet.
    A row at the very place of the first (a repeated input row) is neither.
    """
    order = np.argsort(key)
    k = key[order]
    same = k[1:] == k[:-1]
    # Only rows of repeated keys need the order of their places.
    among = np.zeros(len(k), bool)
    among[1:] = same
    among[:-1] |= same
    some = order[among]
    some = some[np.lexsort((pos[some], doc[some], key[some]))]
    order[among] = some
    k, d, p, c = key[some], doc[some], pos[some], check[some]
    new = np.ones(len(some), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(some)), 0))
    later = (d != d[head]) | (p != p[head])
    among[among] = ~new
    return order[~among], some[later]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals [start, end) joined where they touch or overlap, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(new)
    return start[at], end[np.concatenate([at[1:] - 1, [len(end) - 1]])]
