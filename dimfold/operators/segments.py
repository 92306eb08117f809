"""Histories in numbered segments of bounded length (operators A3-A5, F1-F3).

A cumulative row that carries an entity's whole history grows with the entity: one that holds a third of all facts makes
a row of a third of the table, gathered in one task.  Here a history is cut into segments::

    (entity, segment, n_items, first, last, items)      items: at most ``bound`` structs in order

An item's place in its entity's history is found without gathering the entity: rows are dealt into ranges of (entity,
order), numbered within each range, and the counts of the ranges before are added (a row per entity and range).  A
segment is then an aggregate of ``bound`` rows.

``append`` adds later items by rewriting the open last segment of each entity that has some, and nothing else.
Reads of histories work on segments: ``explode`` (A4), ``first_last`` (A5), and a snapshot of an earlier period is the
items up to it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimfold.plans.sinks import materialize

BOUND = 1000


def numbered(rows: DataFrame, key: str, order: Sequence[str], out: str = "place") -> DataFrame:
    """Rows with their place (from 0) among their entity's rows in the given order, which must be total."""
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(key, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(spark, ranged, "ranges")                 # fixes which range a row is in
    place = F.row_number().over(Window.partitionBy("_range", key).orderBy(*order))
    counts = ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(key).alias("_key"), F.col("_range").alias("_at"), F.coalesce(before, F.lit(0)).alias("_before"))
    # only entities that go over a range's end need an offset
    offsets = offsets.where("_before > 0")
    joined = ranged.withColumn("_place", place).join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_at")), "left")
    return joined.select(*rows.columns, (F.col("_place") - 1 + F.coalesce("_before", F.lit(0))).alias(out))


def _cut(placed: DataFrame, key: str, order: Sequence[str], items: Sequence[str], bound: int) -> DataFrame:
    """Segments of rows that have their place; ``order`` columns come first in each item."""
    fields = [*order, *[c for c in items if c not in order]]
    item = F.struct(*fields)
    return (placed.groupBy(key, F.floor(F.col("place") / bound).cast("long").alias("segment"))
            .agg(F.count(F.lit(1)).alias("n_items"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"),
                 F.sort_array(F.collect_list(item)).alias("items")))


def build(rows: DataFrame, key: str, order: Sequence[str], items: Sequence[str], bound: int = BOUND) -> DataFrame:
    """Segments of all rows."""
    fields = [key, *order, *[c for c in items if c not in order]]
    return _cut(numbered(rows.select(*fields), key, order), key, order, items, bound)


def append(segments: DataFrame, rows: DataFrame, key: str, order: Sequence[str], items: Sequence[str], bound: int = BOUND) -> DataFrame:
    """The segments that new rows, all later than the stored ones, change or add: to be upserted by (key, segment).

    The open segments of the entities with new rows are read with them; closed segments are not.
    """
    fields = [key, *order, *[c for c in items if c not in order]]
    touched = rows.select(key).distinct()
    last = segments.join(touched, key, "left_semi").groupBy(key).agg(F.max("segment").alias("segment"))
    last = materialize(segments.sparkSession, last, "open_segments")
    open_rows = segments.join(last, [key, "segment"], "left_semi").select(key, F.inline("items")).select(*fields)
    placed = numbered(open_rows.unionByName(rows.select(*fields)), key, order)
    start = last.select(F.col(key).alias("_k"), (F.col("segment") * bound).alias("_start"))
    placed = placed.join(start, F.col(key) == F.col("_k"), "left").withColumn("place", F.col("place") + F.coalesce("_start", F.lit(0)))
    return _cut(placed.drop("_k", "_start"), key, order, items, bound)


def explode(segments: DataFrame, key: str, until=None, field: str | None = None) -> DataFrame:
    """A4 over segments: a row per entity and item; with ``until``, the items whose ``field`` is at most that."""
    rows = segments if until is None else segments.where(F.col("first") <= until)
    flat = rows.select(key, "segment", F.inline("items"))
    return flat if until is None else flat.where(F.col(field) <= until)


def first_last(segments: DataFrame, key: str, field: str) -> DataFrame:
    """A5 over segments: first and last item's value, item count and growth last / first (NULL on 0)."""
    ends = segments.select(key, "segment", "n_items", F.try_element_at("items", F.lit(1))[field].alias("a"),
                           F.try_element_at("items", F.lit(-1))[field].alias("z"))
    out = ends.groupBy(key).agg(F.min_by("a", "segment").alias("first_value"), F.max_by("z", "segment").alias("last_value"),
                                F.sum("n_items").alias("n_items"))
    return out.withColumn("growth", F.col("last_value") / F.nullif("first_value", F.lit(0)))
