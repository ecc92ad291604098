"""Tables that are built once and read by many queries: written to the shared folder, found again by what they were built from."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Where built tables go when no shared folder is configured (local mode, tests).
LOCAL = "file:///tmp/checkpoints"

_built: dict[tuple[str, str, str], str] = {}
_paths: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a default."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return LOCAL


def state_of(df: DataFrame) -> str:
    """The files that a table is read from, with their sizes and times: what is built from other files is built anew."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    out = []
    for f in sorted(df.inputFiles()):
        at = jvm.org.apache.hadoop.fs.Path(f)
        status = at.getFileSystem(conf).getFileStatus(at)
        out.append(f"{f} {status.getLen()} {status.getModificationTime()}")
    return "\n".join(out)


def built(spark: SparkSession, name: str, sources: list[DataFrame], make: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """The tables that make() gives, written once for one state of the sources; made again after these have changed."""
    key = (spark.sparkContext.applicationId, name, "\n".join(map(state_of, sources)))
    if key not in _built:
        path = f"{folder(spark)}/folioscan/{name}-{uuid.uuid4().hex}"
        _paths.append((spark, path))
        schemas = {}
        for table, df in make().items():
            df.write.parquet(f"{path}/{table}")
            schemas[table] = df.schema
        _built[key] = path
        _schemas[path] = schemas
    path = _built[key]
    return {table: spark.read.schema(schema).parquet(f"{path}/{table}") for table, schema in _schemas[path].items()}


_schemas: dict[str, dict] = {}


def _at_exit() -> None:
    for spark, path in _paths:
        if getattr(spark.sparkContext, "_jsc", None) is not None:
            with contextlib.suppress(Exception):
                at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


atexit.register(_at_exit)
