"""Slowly changing dimensions (operators B1, B2 a-d, T3, T4).

* ``scd2_full``: gaps-and-islands.  ``lag`` and the running ``sum`` share one
  window partitioned by the entity key, and the collapse groups by a superset
  of that key, so the whole build is a single hash exchange.
* ``scd2_incremental``: the open rows of the previous run and the new snapshot
  meet in **one** full outer join on the key (the scripts join the same two
  inputs three times).  Each joined row yields one or two SCD records
  (``inline`` of a 1-2 element array); closed history passes through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: the actors SCD layout
ACTOR_KEY = "actor_id"
ACTOR_TRACKED = ("quality_class", "is_active")
ACTOR_CARRY = ("actor_name",)


def _distinct(cols: Sequence[str], a: str, b: str) -> Column:
    """Null-safe "is distinct from" over several columns of two aliases."""
    return reduce(lambda x, y: x | y, [~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols])


def scd2_full(snapshots: DataFrame, cutoff: int, key: str = ACTOR_KEY, period: str = "year",
              tracked: Sequence[str] = ACTOR_TRACKED, carry: Sequence[str] = ACTOR_CARRY,
              start_col: str = "start_year", end_col: str = "end_year", run_col: str = "current_year") -> DataFrame:
    """B1: type-2 history of ``tracked`` over all periods ``<= cutoff``, stamped with the run."""
    w = Window.partitionBy(key).orderBy(period)
    changed = reduce(lambda x, y: x | y, [~F.col(c).eqNullSafe(F.lag(c, 1).over(w)) for c in tracked])
    s = snapshots.where(F.col(period) <= cutoff).select(key, *carry, *tracked, period)
    s = s.withColumn("_chg", changed.cast("int")).withColumn("_streak", F.sum("_chg").over(w))
    out = s.groupBy(key, *tracked, "_streak").agg(
        *[F.max(c).alias(c) for c in carry],
        F.min(period).alias(start_col),
        F.max(period).alias(end_col),
    )
    return out.select(key, *carry, *tracked, start_col, end_col, F.lit(cutoff).alias(run_col))


def scd2_branches(scd: DataFrame, snapshot: DataFrame, prev_run: int, period_value: int, key: str = ACTOR_KEY,
                  period: str = "year", tracked: Sequence[str] = ACTOR_TRACKED, carry: Sequence[str] = ACTOR_CARRY,
                  start_col: str = "start_year", end_col: str = "end_year", run_col: str = "current_year",
                  on_missing: str = "keep") -> DataFrame:
    """The single join of B2: one row per key with ``branch`` and its 1-2 ``records``.

    branch: ``unchanged`` (open row extended to the new period), ``changed`` (old
    row closed, new one opened), ``new`` (no open row), ``missing`` (open row, no
    snapshot row: kept as it is unless ``on_missing='drop'``).
    """
    prev = scd.where(F.col(run_col) == prev_run)
    o = prev.where(F.col(end_col) == prev_run).select(key, *carry, *tracked, start_col, end_col, F.lit(True).alias("_o"))
    s = snapshot.where(F.col(period) == period_value).select(key, *carry, *tracked, F.lit(True).alias("_s"))
    j = o.alias("o").join(s.alias("s"), F.col(f"o.{key}") == F.col(f"s.{key}"), "full_outer")
    p = F.lit(period_value)

    def rec(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in tracked], start.alias(start_col), end.alias(end_col))

    old = rec("o", F.col(f"o.{start_col}"), F.col(f"o.{end_col}"))
    new = rec("s", p, p)
    ext = rec("s", F.col(f"o.{start_col}"), p)
    has_o, has_s = F.col("o._o").isNotNull(), F.col("s._s").isNotNull()
    branch = (
        F.when(~has_o, "new").when(~has_s, "missing")
        .when(_distinct(tracked, "o", "s"), "changed").otherwise("unchanged")
    )
    records = (
        F.when(~has_o, F.array(new)).when(~has_s, F.array(old))
        .when(_distinct(tracked, "o", "s"), F.array(old, new)).otherwise(F.array(ext))
    )
    out = j.select(
        F.coalesce(F.col(f"s.{key}"), F.col(f"o.{key}")).alias(key),
        *[F.coalesce(F.col(f"s.{c}"), F.col(f"o.{c}")).alias(c) for c in carry],
        branch.alias("branch"),
        records.alias("records"),
    )
    if on_missing == "drop":
        out = out.where(F.col("branch") != "missing")
    return out


def scd2_closed(scd: DataFrame, prev_run: int, key: str = ACTOR_KEY, tracked: Sequence[str] = ACTOR_TRACKED,
                carry: Sequence[str] = ACTOR_CARRY, start_col: str = "start_year", end_col: str = "end_year",
                run_col: str = "current_year") -> DataFrame:
    """B2d: history rows that ended before the previous run, passed through."""
    prev = scd.where((F.col(run_col) == prev_run) & (F.col(end_col) < prev_run))
    return prev.select(key, *carry, *tracked, start_col, end_col)


def explode_branches(branches: DataFrame, key: str = ACTOR_KEY, carry: Sequence[str] = ACTOR_CARRY) -> DataFrame:
    return branches.select(key, *carry, F.inline("records"))


def scd2_incremental(scd: DataFrame, snapshot: DataFrame, prev_run: int, period_value: int,
                     run_col: str = "current_year", **kw) -> DataFrame:
    """B2: next run of the SCD2 table = closed history + the records of the single join."""
    br = scd2_branches(scd, snapshot, prev_run, period_value, run_col=run_col, **kw)
    key = kw.get("key", ACTOR_KEY)
    carry = kw.get("carry", ACTOR_CARRY)
    closed_kw = {k: v for k, v in kw.items() if k in ("key", "tracked", "carry", "start_col", "end_col")}
    opened = explode_branches(br, key, carry)
    closed = scd2_closed(scd, prev_run, run_col=run_col, **closed_kw)
    return closed.unionByName(opened).withColumn(run_col, F.lit(period_value))


# ---------------------------------------------------------------------- T3 / T4

def scd_type0(snapshots: DataFrame, key: str, period: str, cols: Sequence[str]) -> DataFrame:
    """T3 type 0: the value at the entity's first period, never updated."""
    first = F.min_by(F.struct(*cols), F.col(period))
    return snapshots.groupBy(key).agg(first.alias("_v")).select(key, *[F.col(f"_v.{c}").alias(c) for c in cols])


def scd_type1(snapshots: DataFrame, key: str, period: str, cols: Sequence[str]) -> DataFrame:
    """T3 type 1: only the latest value (and the period it is from)."""
    last = F.max_by(F.struct(*cols), F.col(period))
    return snapshots.groupBy(key).agg(last.alias("_v"), F.max(period).alias(period)).select(
        key, *[F.col(f"_v.{c}").alias(c) for c in cols], period
    )


def scd_type3(snapshots: DataFrame, key: str, period: str, cols: Sequence[str]) -> DataFrame:
    """T3 type 3: original and current value on one row."""
    first = F.min_by(F.struct(*cols), F.col(period))
    last = F.max_by(F.struct(*cols), F.col(period))
    return snapshots.groupBy(key).agg(first.alias("_o"), last.alias("_c")).select(
        key,
        *[F.col(f"_o.{c}").alias(f"original_{c}") for c in cols],
        *[F.col(f"_c.{c}").alias(f"current_{c}") for c in cols],
    )


def scd2_as_of(scd: DataFrame, period_value: int | Column, start_col: str = "start_year",
               end_col: str = "end_year") -> DataFrame:
    """T4: rows valid at a point in time (``start <= p <= end``)."""
    p = period_value if isinstance(period_value, Column) else F.lit(period_value)
    return scd.where((F.col(start_col) <= p) & (p <= F.col(end_col)))


def scd2_expand(scd: DataFrame, key: str = ACTOR_KEY, tracked: Sequence[str] = ACTOR_TRACKED,
                period: str = "year", start_col: str = "start_year", end_col: str = "end_year") -> DataFrame:
    """T4: the per-period snapshot regained from SCD2 ranges (narrow: explode of a sequence)."""
    return scd.select(key, *tracked, F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias(period))


def scd2_join_as_of(facts: DataFrame, scd: DataFrame, key: str = ACTOR_KEY, period: str = "year",
                    start_col: str = "start_year", end_col: str = "end_year",
                    attrs: Sequence[str] = ACTOR_TRACKED, how: str = "left") -> DataFrame:
    """T4: each fact with the dimension version valid at its period.

    An equi-join on the key with the range as a residual predicate: each key
    has only a handful of versions, so the join is a hash/sort-merge join on
    the key, not a range or cross join.
    """
    dim = scd.select(F.col(key).alias("_k"), F.col(start_col).alias("_s"), F.col(end_col).alias("_e"), *attrs)
    cond = (F.col(key) == F.col("_k")) & (F.col("_s") <= F.col(period)) & (F.col(period) <= F.col("_e"))
    return facts.join(dim, cond, how).drop("_k", "_s", "_e")
