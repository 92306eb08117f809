"""Sinks: upsert, snapshot partitions, bucketed tables (operators H1, H2, T6).

Snapshots are written per run period into their own partition with dynamic
partition overwrite, so re-running a period replaces it (idempotent) and the
next period reads files instead of a growing lineage.  A table that is read and
rewritten in the same run (month arrays) is staged to a fresh path first, so a
failed job never leaves the table without its source.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimfold.session import shared_dir


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """H1: insert-or-replace by key: one full outer join, the incoming row where there is one.

    A key that comes in twice is an error, as for an insert with a conflict clause.  Null keys never
    conflict, so such rows are all kept.
    """
    row = F.struct(*[F.col(c) for c in existing.columns])
    null_key = reduce(or_, [F.col(k).isNull() for k in keys])
    alone = F.count(F.lit(1)).over(Window.partitionBy(*keys)) == 1
    new = incoming.select(*existing.columns).select(*keys, F.when(alone | null_key, row).otherwise(
        F.raise_error(F.lit("a key comes in more than once"))).alias("_new"))
    old = existing.select(*keys, row.alias("_old"))
    return old.join(new, list(keys), "full_outer").select(F.coalesce("_new", "_old").alias("_r")).select("_r.*")


def write_snapshot(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet") -> None:
    """H2: overwrite only the partitions present in ``df`` (dynamic partition overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).format(fmt).save(path))


def read_snapshot(spark: SparkSession, path: str, where=None, fmt: str = "parquet") -> DataFrame:
    df = spark.read.format(fmt).load(path)
    return df if where is None else df.where(where)


def materialize(spark: SparkSession, df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint dir and read it back.

    Cuts lineage with a durable copy (survives executor loss, unlike a local
    checkpoint) and is how a fold over many periods keeps plans short.
    """
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_bucketed(df: DataFrame, table: str, buckets: int, keys: Sequence[str], path: str) -> None:
    """Pre-shuffle a fact by key into a bucketed table (later group-bys/joins on ``keys`` skip the exchange)."""
    # one writer per bucket: without the shuffle every task would write a file for each bucket
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", path).saveAsTable(table))
