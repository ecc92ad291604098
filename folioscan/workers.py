"""Python workers import this package by name; they look for it where the driver found it."""

from __future__ import annotations

import contextlib
import ctypes
import os

import pyarrow as pa
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def find_us(spark: SparkSession) -> None:
    known = spark.sparkContext.environment
    if ROOT not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known.get("PYTHONPATH", "")]))


def few_rows(spark: SparkSession, most: int = 2000) -> None:
    """Bound the rows of an Arrow batch: texts can be long, and a batch is held whole on both sides."""
    with contextlib.suppress(Exception):
        if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > most:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(most))


def give_back() -> None:
    """Hand freed memory back to the system: Python workers outlive their tasks, and each would keep what its largest step took."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(Exception):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)
