"""Corrections of daily folds: late events replayed for the changed entities alone.

A folded table has a snapshot a day, and each day's rows carry all days before.  An event that arrives after its day was
folded changes its entity in that snapshot and in every later one.  Rewriting those snapshots would rewrite all entities;
here a correction writes rows of the changed entities only, beside the snapshots::

    <path>/date=2024-01-28/fix=0      the snapshot as folded
    <path>/date=2024-01-28/fix=7      later rows of some of its entities; the greatest fix counts

``log`` keeps what arrived late, a row per entity and day under the number of the batch.  ``replay`` takes the entities of
one batch, starts from their rows of the day before the earliest late day (or builds the first snapshot's rows anew, if
there is no day before it), and folds day after day to the newest snapshot, with the same step that folds whole days, over
the events of these entities.  ``corrected`` reads a table with its corrections; ``compact`` rewrites a day as one whole
snapshot once many corrections have gathered.

Batches are numbered, and a batch that runs again overwrites its own partitions, so nothing is applied twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimfold.plans.sinks import materialize

FIX = "fix"
#: step(events, yesterday, day) -> rows of the day
DayStep = Callable[[DataFrame, DataFrame, dt.date], DataFrame]
#: build(events, day) -> rows of the day from all events up to it
DayBuild = Callable[[DataFrame, dt.date], DataFrame]


def write_day(rows: DataFrame, path: str, day_col: str = "date", fix: int = 0) -> None:
    (rows.withColumn(FIX, F.lit(fix)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col, FIX).parquet(path))


def corrected(spark: SparkSession, path: str, keys: Sequence[str], day_col: str = "date", days: Sequence[dt.date] = ()) -> DataFrame:
    """Rows of the folded table, each entity's by its greatest fix; ``days`` prunes the read to some snapshots.

    Corrections are few beside the snapshots: these are read without a shuffle where the corrected keys are small enough
    to be broadcast by size.
    """
    table = spark.read.option("basePath", path).parquet(path)
    if days:
        table = table.where(F.col(day_col).isin(*days))
    rows = [c for c in table.columns if c != FIX]
    fixes = table.where(F.col(FIX) > 0)
    on = [*keys, day_col]
    last = (fixes.groupBy(*on).agg(F.max_by(F.struct(*[c for c in rows if c not in on]), FIX).alias("_r"))
            .select(*on, "_r.*").select(*rows))
    base = table.where(F.col(FIX) == 0).select(*rows).join(fixes.select(*on).distinct(), on, "left_anti")
    return base.unionByName(last)


def late_entities(batch: DataFrame, newest: dt.date, keys: Sequence[str], event_time: str = "event_time") -> DataFrame:
    """(keys, day) of a batch's events of days that are folded already; rows without a key belong to no entity."""
    day = F.to_date(event_time)
    rows = batch.where((day <= F.lit(newest)))
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    return rows.select(*keys, day.alias("late_day")).distinct()


def log_late(rows: DataFrame, path: str, batch: int) -> None:
    """Keep a batch's late entities and days."""
    (rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def snapshots(spark: SparkSession, path: str, day_col: str = "date") -> tuple[dt.date, dt.date]:
    """First and last day of the folded table (read from its partitions)."""
    r = spark.read.option("basePath", path).parquet(path).agg(F.min(day_col).alias("a"), F.max(day_col).alias("b")).first()
    return r.a, r.b


def replay(spark: SparkSession, path: str, events: DataFrame, late: DataFrame, step: DayStep, build: DayBuild, event_keys: dict[str, str],
           batch: int, event_time: str = "event_time", day_col: str = "date") -> int:
    """Correct the snapshots from the earliest late day on, for the late entities alone; returns the number of days written.

    ``event_keys`` names the table's key columns by the events' columns; ``late`` has the events' key columns.
    """
    since = late.agg(F.min("late_day")).first()[0]
    if since is None:
        return 0
    first, last = snapshots(spark, path, day_col)
    entities = materialize(spark, late.select(*event_keys).distinct(), "late_entities")
    theirs = events.join(entities, list(event_keys), "left_semi")
    keys = list(event_keys.values())
    day = max(since, first)
    if day == first:
        rows = build(theirs, day)                                   # no snapshot before it to step from
    else:
        before = day - dt.timedelta(days=1)
        named = entities.select(*[F.col(e).cast(t).alias(k) for (e, k), t in zip(event_keys.items(), _types(spark, path, keys), strict=True)])
        yesterday = corrected(spark, path, keys, day_col, [before]).join(named, keys, "left_semi")
        rows = step(theirs.where(F.to_date(event_time) == F.lit(day)), yesterday, day)
    written = 0
    while True:
        rows = materialize(spark, rows, "replayed")                 # the next day reads files: the plan stays one step deep
        write_day(rows, path, day_col, batch)
        written += 1
        if day >= last:
            return written
        yesterday, day = rows, day + dt.timedelta(days=1)
        rows = step(theirs.where(F.to_date(event_time) == F.lit(day)), yesterday, day)


def _types(spark: SparkSession, path: str, keys: Sequence[str]):
    schema = spark.read.option("basePath", path).parquet(path).schema
    return [schema[k].dataType for k in keys]


def compact(spark: SparkSession, path: str, keys: Sequence[str], day: dt.date, day_col: str = "date") -> None:
    """Write a day as one snapshot, its corrections included, under the next number; it then stands for all before it."""
    table = spark.read.option("basePath", path).parquet(path).where(F.col(day_col) == F.lit(day))
    fix = table.agg(F.max(FIX)).first()[0]
    rows = materialize(spark, corrected(spark, path, keys, day_col, [day]), "compacted")
    write_day(rows, path, day_col, 0)               # the whole day first: until the corrections go, they say the same
    for n in range(1, (fix or 0) + 1):
        _drop(spark, f"{path}/{day_col}={day.isoformat()}/{FIX}={n}")


def _drop(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)
