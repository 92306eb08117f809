"""De-duplication of a day's events by a merge tree over its hours (operator T1).

Every hour keeps one row per key: the first event of the key in that hour and how many copies came in.  Two neighbouring
hours are merged into a node that again keeps one row per key, two such nodes into the next, up to the root, which holds
the day.  All nodes are stored, a partition each::

    <path>/level=0/day=2024-01-30/node=13     an hour
    <path>/level=1/day=2024-01-30/node=6      hours 12 and 13
    ...
    <path>/level=5/day=2024-01-30/node=0      the day

Events that arrive late change the leaf of their hour; only the nodes above it are merged anew, from two stored children
each: as many as the tree has levels, whatever else the day holds.  A leaf is built from all landed events of its hour
(a read with the hours' time range pushed down), not from what it held before, so an update that runs again after a
failure writes the same rows again.  Leaves are written before the nodes above them: an update that stops half way
leaves whole, older nodes, and the next run of the same batch finishes it.

Merges are keyed aggregates with partial sums before the shuffle, so a key or an hour with a large share of the rows is
reduced to one row a task before it moves, and all nodes of a level that need merging are merged in one job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

HOURS = 24
LEVELS = 5          # 2 ** LEVELS hours cover a day
COPIES = "n_copies"


def _first(rows: DataFrame, keys: Sequence[str], payload: Sequence[str], order: Sequence[str], copies: Column) -> DataFrame:
    """One row per day, node and key: the payload of the first row in order, and the sum of the copies."""
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload if c not in order])
    picked = rows.groupBy("day", "node", *keys).agg(F.min(rank).alias("_first"), F.sum(copies).alias(COPIES))
    return picked.select("day", "node", *keys, *[F.col("_first")[c].alias(c) for c in payload], COPIES)


def _write(rows: DataFrame, path: str, level: int, keys: Sequence[str]) -> None:
    """Replace the partitions of the nodes in ``rows``; neighbouring nodes share a task, a large one is cut by its keys."""
    (rows.repartitionByRange("day", "node", F.xxhash64(*keys)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "node").parquet(f"{path}/level={level}"))


def _hours(events: DataFrame, event_time: str) -> list[tuple[dt.date, int]]:
    """The hours that a batch has events of: one entry an hour, however many events."""
    found = events.where(F.col(event_time).isNotNull()).select(F.to_date(event_time).alias("day"), F.hour(event_time).alias("node")).distinct()
    return sorted((r.day, r.node) for r in found.collect())


def _nodes_where(nodes: Sequence[tuple[dt.date, int]]) -> Column:
    """Condition on the partition columns: the listed nodes of each day."""
    by_day: dict[dt.date, list[int]] = {}
    for day, node in nodes:
        by_day.setdefault(day, []).append(node)
    return reduce(or_, [(F.col("day") == F.lit(d)) & F.col("node").isin(*ns) for d, ns in by_day.items()])


def read_level(spark: SparkSession, path: str, level: int) -> DataFrame:
    return spark.read.option("basePath", f"{path}/level={level}").parquet(f"{path}/level={level}")


def update(spark: SparkSession, path: str, events: DataFrame, hours: Sequence[tuple[dt.date, int]], keys: Sequence[str],
           event_time: str = "event_time", order: Sequence[str] = ("event_time", "event_id")) -> list[list[tuple[dt.date, int]]]:
    """Rebuild the leaves of ``hours`` from all landed ``events`` and merge what stands above them.

    Returns the nodes that were written at each level.  Events without a time belong to no hour and are left out.
    """
    hours = sorted(set(hours))
    if not hours:
        return []
    payload = [c for c in events.columns if c not in keys]
    time = F.col(event_time)
    kind = events.schema[event_time].dataType
    at = lambda day, hour: F.lit(dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=hour)).cast(kind)
    # runs of hours as time ranges: they reach the scan of the landed files
    runs: list[list[tuple[dt.date, int]]] = []
    for h in hours:
        if runs and runs[-1][-1] in ((h[0], h[1] - 1), (h[0] - dt.timedelta(days=1), HOURS - 1 if h[1] == 0 else None)):
            runs[-1].append(h)
        else:
            runs.append([h])
    inside = reduce(or_, [(time >= at(*r[0])) & (time < at(r[-1][0], r[-1][1] + 1)) for r in runs])
    leaves = events.where(inside).withColumn("day", F.to_date(event_time)).withColumn("node", F.hour(event_time))
    _write(_first(leaves, keys, payload, order, F.lit(1)), path, 0, keys)
    written = [hours]
    for level in range(1, LEVELS + 1):
        parents = sorted({(day, node // 2) for day, node in written[-1]})
        children = [(day, 2 * node + k) for day, node in parents for k in (0, 1)]
        below = read_level(spark, path, level - 1).where(_nodes_where(children))
        merged = _first(below.withColumn("node", F.floor(F.col("node") / 2).cast("int")), keys, payload, order, F.col(COPIES))
        _write(merged, path, level, keys)
        written.append(parents)
    return written


def day_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per day and key, from the roots: the first event and the number of copies."""
    return read_level(spark, path, LEVELS).drop("node")


def tree_on_arrival(spark: SparkSession, landing_path: str, schema: StructType, path: str, keys: Sequence[str], checkpoint: str,
                    event_time: str = "event_time", order: Sequence[str] = ("event_time", "event_id"),
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Keep the trees up to date with every batch of landed files; returns the days' rows.

    A batch only tells which hours have received events.  Hours that were complete before and get more are the late ones.
    """

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        landed = spark.read.schema(schema).parquet(landing_path)
        update(spark, path, landed, _hours(batch, event_time), keys, event_time, order)

    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    query = (reader.load(landing_path).select(event_time).writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return day_rows(spark, path)
