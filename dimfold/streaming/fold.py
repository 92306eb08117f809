"""Daily folds driven by a stream of landed event files (``foreachBatch`` + snapshot partitions).

A micro-batch only tells which days have received data.  A day is complete
once data of a later day has arrived; every complete day that is not yet in the
snapshot table is folded once, in order, from *all* landed events of that day
(a batch read of the landing folder with the day filter pushed into the scan),
so a day whose events were spread over several micro-batches is still folded
from its whole data.  Each day's snapshot is written to its own partition; a
micro-batch re-run after a failure rewrites the same partitions (idempotent),
and the streaming checkpoint lives in the shared folder.

``fold_with_corrections`` also takes events that arrive after their day was folded: the changed entities are logged
and replayed through the later snapshots (``dimfold.plans.corrections``), the others are not touched.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimfold.plans import corrections
from dimfold.plans.sinks import materialize, read_snapshot, write_snapshot

DayStep = Callable[[DataFrame, DataFrame, dt.date], DataFrame]


def fold_on_arrival(spark: SparkSession, landing_path: str, schema: StructType, table_path: str, step: DayStep,
                    checkpoint: str, event_time: str = "event_time", partition_col: str = "date",
                    stage: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Fold every completed day into the snapshot table at ``table_path``.

    ``step(events, table, day)`` returns the partition(s) of ``day`` given all
    landed events and the stored table; the table must already hold the
    snapshot of the day before the first day to fold (the bootstrap).
    """

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        newest = batch.select(F.max(F.to_date(event_time))).first()[0]
        if newest is None:
            return
        folded = read_snapshot(spark, table_path).select(F.max(partition_col)).first()[0]
        events = spark.read.schema(schema).parquet(landing_path)
        day = folded + dt.timedelta(days=1)
        while day < newest:
            out = step(events, read_snapshot(spark, table_path), day)
            if stage:
                out = materialize(spark, out, "fold_stage")
            write_snapshot(out, table_path, [partition_col])
            day += dt.timedelta(days=1)

    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (reader.load(landing_path).select(event_time).writeStream
             .foreachBatch(on_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_snapshot(spark, table_path)


def fold_with_corrections(spark: SparkSession, landing_path: str, schema: StructType, table_path: str, log_path: str,
                          step: corrections.DayStep, build: corrections.DayBuild, event_keys: dict[str, str], checkpoint: str,
                          event_time: str = "event_time", day_col: str = "date", max_files_per_trigger: int | None = None) -> DataFrame:
    """Fold every completed day and correct folded days when events of theirs arrive later.

    ``step(events, yesterday, day)`` folds a day, ``build(events, day)`` makes a day's rows from all events up to it;
    ``event_keys`` maps the events' key columns to the table's.  The table at ``table_path`` must hold the bootstrap
    snapshot, written by ``corrections.write_day``.
    """
    keys = list(event_keys.values())

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        seen = batch.agg(F.min(F.to_date(event_time)).alias("a"), F.max(F.to_date(event_time)).alias("b")).first()
        if seen.b is None:
            return
        _, folded = corrections.snapshots(spark, table_path, day_col)
        events = spark.read.schema(schema).parquet(landing_path)
        number = epoch_id + 1                                       # 0 are the snapshots themselves
        if seen.a <= folded:
            corrections.log_late(corrections.late_entities(batch, folded, list(event_keys), event_time), log_path, number)
            late = spark.read.option("basePath", log_path).parquet(log_path).where(F.col("batch") == number)
            corrections.replay(spark, table_path, events, late, step, build, event_keys, number, event_time, day_col)
        day = folded + dt.timedelta(days=1)
        while day < seen.b:
            yesterday = corrections.corrected(spark, table_path, keys, day_col, [day - dt.timedelta(days=1)])
            today = events.where(F.to_date(event_time) == F.lit(day))
            corrections.write_day(step(today, yesterday, day), table_path, day_col)
            day += dt.timedelta(days=1)

    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (reader.load(landing_path).select(event_time, *event_keys).writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return corrections.corrected(spark, table_path, keys, day_col)
