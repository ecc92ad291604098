"""The streaming twin of call analytics: windows by event time, late rows bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_hour(calls: DataFrame, time: str = "ts", tool: str = "tool", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """(start, tool, calls, errors, mean_ms): tumbling windows; works on a stream and on a table."""
    own = calls.withWatermark(time, late) if calls.isStreaming else calls
    out = own.groupBy(F.window(time, width).alias("w"), tool).agg(F.count("*").alias("calls"), F.count_if("error").alias("errors"), F.round(F.avg("ms"), 6).alias("mean_ms"))
    return out.select(F.col("w.start").alias("start"), tool, "calls", "errors", "mean_ms")


def sessions(calls: DataFrame, time: str = "ts", who: str = "token_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(who, start, stop, calls): a session ends after so long a gap."""
    own = calls.withWatermark(time, late) if calls.isStreaming else calls
    out = own.groupBy(F.session_window(time, gap).alias("w"), who).agg(F.count("*").alias("calls"))
    return out.select(who, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "calls")


def first_searches(calls: DataFrame, key: list[str], time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Calls without repeats of the same key within the watermark."""
    if calls.isStreaming:
        return calls.withWatermark(time, late).dropDuplicatesWithinWatermark(key)
    return calls.dropDuplicates(key)


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything there is, in micro-batches, into parquet at path; restartable from the checkpoint."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
