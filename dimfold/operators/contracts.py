"""Data contracts (operators K1, K2): closed value sets and declared keys.

Spark neither has enum types nor enforces primary keys; these turn both into
checks.  Violations are DataFrames (so they can be counted, stored or joined
back) and are computed with partial aggregation, never by collecting rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enum_violations(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """K1: rows whose value is outside the closed set (NULL is allowed)."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(*allowed))


def enum_enforce(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """K1 strict form: the query fails on the first value outside the set (like an enum cast)."""
    ok = F.col(col).isNull() | F.col(col).isin(*allowed)
    msg = F.concat(F.lit(f"invalid value for {col}: "), F.col(col).cast("string"))
    return df.withColumn(col, F.when(ok, F.col(col)).otherwise(F.raise_error(msg).cast(df.schema[col].dataType)))


def enum_profile(df: DataFrame, col: str, allowed: Sequence[str]) -> DataFrame:
    """K1 report: each distinct value, its row count and whether it is allowed."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "is_allowed", F.col("value").isNull() | F.col("value").isin(*allowed)
    )


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n_rows): the distinct keys, those with a NULL part among them."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def violations(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K2 over counted keys."""
    any_null = _any_null(keys)
    return counted.where(any_null | (F.col("n_rows") > 1)).withColumn(
        "violation", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate"))
    )


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K2: keys that repeat (``duplicate``) and key groups with a NULL part (``null_key``)."""
    return violations(key_counts(df, keys), keys)


def key_summary(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """K2 report, one row: rows, distinct keys and keys that repeat or have a NULL part."""
    return key_counts(df, keys).withColumnRenamed("n_rows", "n").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
        F.count_if(_any_null(keys) | (F.col("n") > 1)).alias("n_violations"),
    ).select(F.lit(name).alias("table_name"), "n_rows", "n_keys", "n_violations")
