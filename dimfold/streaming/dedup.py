"""Windowed de-duplication of a stream (operator T1).

Duplicates only matter within a time window.  Structured Streaming keeps one
state entry per key until the watermark (max event time seen minus ``delay``)
passes it, then evicts it, so state stays bounded by the window instead of the
whole history.  Copies that arrive within the delay are dropped; rows older
than the watermark are late and are dropped by the stateful operator as well.

The watermark needs a ``timestamp`` column; a ``timestamp_ntz`` event time is
cast (in the session time zone) into a helper column, and the original column
is kept in the output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WM_COL = "_event_ts"


def dedup_within_watermark(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Stream -> stream: first copy of every key within ``delay`` of event time."""
    s = stream.withColumn(WM_COL, F.col(event_time).cast("timestamp"))
    return s.withWatermark(WM_COL, delay).dropDuplicatesWithinWatermark(list(keys)).drop(WM_COL)


def run_dedup(spark: SparkSession, source_path: str, schema: StructType, keys: Sequence[str], event_time: str,
              delay: str, out_path: str, checkpoint: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Run the de-duplication over every file present at ``source_path`` (``availableNow``).

    Output and checkpoint live in shared storage, so a restarted query resumes
    where the committed offsets left off.  Returns the de-duplicated rows.
    """
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    deduped = dedup_within_watermark(reader.load(source_path), keys, event_time, delay)
    query = (deduped.writeStream.format("parquet").outputMode("append")
             .option("path", out_path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(schema).parquet(out_path)


def dedup_hourly_batch(events: DataFrame, keys: Sequence[str], event_time: str) -> DataFrame:
    """Batch form of the hourly micro-batch dedup: one pass per hour, then one across hours.

    Partitioning by the hour first keeps each de-duplication local to the hour
    (no pairwise join tree is needed); the second pass removes copies that
    crossed an hour boundary.
    """
    hour = F.date_trunc("hour", F.col(event_time))
    per_hour = events.withColumn("_hour", hour).dropDuplicates([*keys, "_hour"]).drop("_hour")
    return per_hour.dropDuplicates(list(keys))
