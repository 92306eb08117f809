"""Reduced facts: one array per entity and month, indexed by day (operators G1-G4).

Daily steps full-outer-join today's pre-aggregated counts with the month rows
on the entity key.  A stored array is first cut back (or zero-padded) to the
days before the run date, so re-running a day replaces that day's value instead
of appending it twice (idempotent).  Batch builders never join a date spine:
each (entity, month) group gathers its <= 31 daily values and the dense array is
built with ``transform(sequence(1, days), ...)`` in the same row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.functions import arrays
from dimfold.operators.datelist import _date, _day, host_day_counts


def _dense(entries: Column, first_day: Column, last_day: Column, field: str, zero: Column) -> Column:
    """Values of ``entries`` (structs with ``date`` and ``field``) for every day in [first_day, last_day]."""
    days = F.sequence(first_day, last_day)
    return F.transform(days, lambda d: F.coalesce(
        arrays.first(F.filter(entries, lambda e: e["date"] == d))[field], zero))


def _month_end(month: Column, run_date: Column) -> Column:
    return F.least(F.last_day(month), run_date)


# ------------------------------------------------------------------ G1: array_metrics

def _user_hits(events: DataFrame, cond: Column) -> DataFrame:
    return (events.where(cond & F.col("user_id").isNotNull())
            .groupBy("user_id", _day().alias("date")).agg(F.count(F.lit(1)).cast("double").alias("hits")))


def metric_step(events: DataFrame, month_table: DataFrame, run_date, metric: str = "site_hits") -> DataFrame:
    """G1: the run date's value appended to each user's array of the run date's month.

    Users first seen mid-month get ``day-1`` leading zeros; users of the month
    without activity today get 0.  Returns the month's rows (to be upserted).
    """
    d = _date(run_date)
    month, day = F.trunc(d, "MM"), F.dayofmonth(d)
    t = _user_hits(events, _day() == d).select("user_id", "hits").alias("t")
    y = month_table.where((F.col("month_start") == month) & (F.col("metric_name") == metric)).alias("y")
    j = t.join(y, F.col("t.user_id") == F.col("y.user_id"), "full_outer")
    today = F.array(F.coalesce(F.col("t.hits"), F.lit(0.0)))
    zero = F.lit(0.0)
    arr = F.when(F.col("y.metric_array").isNotNull(),
                 F.concat(arrays.fit_length(F.col("y.metric_array"), day - 1, zero), today)
                 ).otherwise(F.concat(F.array_repeat(zero, day - 1), today))
    return j.select(
        F.coalesce(F.col("t.user_id"), F.col("y.user_id")).alias("user_id"),
        month.alias("month_start"),
        F.lit(metric).alias("metric_name"),
        arr.alias("metric_array"),
    )


def metric_build(events: DataFrame, run_date, metric: str = "site_hits") -> DataFrame:
    """G1 batch: every (user, month) array up to the run date in one aggregation."""
    d = _date(run_date)
    daily = _user_hits(events, _day() <= d)
    per_month = daily.groupBy("user_id", F.trunc("date", "MM").alias("month_start")).agg(
        F.collect_list(F.struct("date", "hits")).alias("_e"))
    return per_month.select(
        "user_id", "month_start", F.lit(metric).alias("metric_name"),
        _dense(F.col("_e"), F.col("month_start"), _month_end(F.col("month_start"), d), "hits", F.lit(0.0))
        .alias("metric_array"),
    )


# ------------------------------------------------------------------ G2 / G3: host_activity_reduced

def host_step(events: DataFrame, host_table: DataFrame, run_date) -> DataFrame:
    """Hits and unique visitors of the run date appended per host.

    Reads the month of ``run_date - 1``: on day 1 that is the previous month, so
    every known host starts the new month (with 0 when inactive today).
    """
    d = _date(run_date)
    prev_month = F.trunc(F.date_sub(d, 1), "MM")
    day = F.dayofmonth(d)
    t = host_day_counts(events, _day() == d).select("host", "events_count", "users_count").alias("t")
    y = host_table.where(F.col("month") == prev_month).alias("y")
    j = t.join(y, F.col("t.host") == F.col("y.host"), "full_outer")
    zero = F.lit(0).cast("long")

    def grow(stored: str, today: str) -> Column:
        val = F.array(F.coalesce(F.col(f"t.{today}"), zero))
        return (
            F.when(day == 1, val)
            .when(F.col(f"y.{stored}").isNotNull(),
                  F.concat(arrays.fit_length(F.col(f"y.{stored}"), day - 1, zero), val))
            .otherwise(F.concat(F.array_repeat(zero, day - 1), val))
        )

    return j.select(
        F.trunc(d, "MM").alias("month"),
        F.coalesce(F.col("t.host"), F.col("y.host")).alias("host"),
        grow("hit_array", "events_count").alias("hit_array"),
        grow("unique_visitors_array", "users_count").alias("unique_visitors_array"),
    )


def host_batch(hosts_cumulated: DataFrame, from_first_seen: bool = False) -> DataFrame:
    """Month arrays of every host for every month from the table's first month to its last date.

    Uses the latest snapshot's date lists; narrow per host (no date-spine join):
    months come from ``sequence`` and each month's array from the host's own
    entries.  ``from_first_seen`` starts each host at the month of its first
    entry (the incremental form never emits earlier months).
    """
    bounds = hosts_cumulated.select(F.struct(F.trunc(F.min("date"), "MM").alias("m0"), F.max("date").alias("hi"))).scalar()
    last = bounds["hi"]
    # the lists of the latest snapshot (a partition of the stored table), for the hosts of every snapshot
    latest = hosts_cumulated.where(F.col("date") == last).select("host", F.col("host_activity_datelist").alias("_l"))
    hosts = hosts_cumulated.select("host").distinct().join(latest, "host", "left")
    # the scalar subquery is bound to columns here: it may not appear inside higher-order functions
    hosts = hosts.select("host", "_l", bounds["m0"].alias("_m0"), last.alias("_hi"))
    start = F.col("_m0")
    if from_first_seen:
        start = F.greatest(start, F.trunc(arrays.first(F.col("_l"))["date"], "MM"))
    months = hosts.select("host", "_l", "_hi", F.explode(
        F.sequence(start, F.trunc(F.col("_hi"), "MM"), F.expr("INTERVAL 1 MONTH"))).alias("month"))
    zero = F.lit(0).cast("long")
    in_month = F.filter(F.coalesce(F.col("_l"), F.array()), lambda e: F.trunc(e["date"], "MM") == F.col("month"))
    end = _month_end(F.col("month"), F.col("_hi"))
    return months.select(
        "month", "host",
        _dense(in_month, F.col("month"), end, "events_count", zero).alias("hit_array"),
        _dense(in_month, F.col("month"), end, "users_count", zero).alias("unique_visitors_array"),
    )


# ------------------------------------------------------------------ G4

def expand(month_table: DataFrame, array_col: str = "metric_array", group: tuple[str, ...] = ("metric_name",),
           month_col: str = "month_start", positions: int | None = None) -> DataFrame:
    """Position-wise sum over entities, then one row per (group, date).

    A position some arrays lack contributes nothing (not 0).  ``positions``
    limits the sum to the first n days.
    """
    x = month_table.select(*group, month_col, F.posexplode(array_col).alias("pos", "v"))
    if positions is not None:
        x = x.where(F.col("pos") < positions)
    agg = x.groupBy(*group, month_col, "pos").agg(F.sum("v").alias("value"))
    return agg.select(*group, F.date_add(F.col(month_col), F.col("pos")).alias("date"), "value")
