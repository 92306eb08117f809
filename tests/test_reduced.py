import datetime as dt

import pytest

from pyspark.sql import functions as F

from conftest import SF_TINY, rows
from dimfold.operators import datelist, reduced
from dimfold.plans import sinks
from dimfold.sources import views

EV = "event_id long, user_id long, device_id long, host string, event_type string, event_time timestamp_ntz"
MT = "user_id long, month_start date, metric_name string, metric_array array<double>"


def _ev(spark, data):
    return spark.createDataFrame(data, EV)


def test_metric_step_padding_absent_and_idempotent(spark):
    ev = _ev(spark, [(1, 1, 1, "h", "v", dt.datetime(2023, 1, 3, 5)), (2, 1, 1, "h", "v", dt.datetime(2023, 1, 3, 6)),
                     (3, 2, 1, "h", "v", dt.datetime(2023, 1, 2, 6))])
    table = spark.createDataFrame([(2, dt.date(2023, 1, 1), "site_hits", [0.0, 1.0])], MT)
    step = reduced.metric_step(ev, table, dt.date(2023, 1, 3))
    got = {r.user_id: r.metric_array for r in step.collect()}
    assert got == {1: [0.0, 0.0, 2.0], 2: [0.0, 1.0, 0.0]}
    once = sinks.upsert(table, step, ["user_id", "month_start", "metric_name"])
    twice = sinks.upsert(once, reduced.metric_step(ev, once, dt.date(2023, 1, 3)), ["user_id", "month_start", "metric_name"])
    assert rows(once) == rows(twice)


def test_host_step_month_rollover(spark):
    ht = spark.createDataFrame([(dt.date(2023, 1, 1), "old", [1, 2], [1, 1]), (dt.date(2023, 1, 1), "both", [3], [1])],
                               "month date, host string, hit_array array<bigint>, unique_visitors_array array<bigint>")
    ev = _ev(spark, [(1, 1, 1, "both", "v", dt.datetime(2023, 2, 1, 1)), (2, 1, 1, "new", "v", dt.datetime(2023, 2, 1, 2))])
    got = {r.host: (r.month, r.hit_array) for r in reduced.host_step(ev, ht, dt.date(2023, 2, 1)).collect()}
    assert got == {"old": (dt.date(2023, 2, 1), [0]), "both": (dt.date(2023, 2, 1), [1]), "new": (dt.date(2023, 2, 1), [1])}


def test_host_fold_equals_batch_from_first_seen(spark):
    ev = views.events(spark, SF_TINY, shift_days=15)
    run = dt.date(2024, 2, 3)
    start = run - dt.timedelta(days=4)
    table = reduced.host_batch(datelist.host_build(ev, start), from_first_seen=True)
    for k in range(3, -1, -1):
        table = sinks.upsert(table, reduced.host_step(ev, table, run - dt.timedelta(days=k)), ["month", "host"])
    # the batch spine starts at the table's earliest snapshot: give it the first and the last one
    hc = datelist.host_build(ev, start).unionByName(datelist.host_build(ev, run))
    batch = reduced.host_batch(hc, from_first_seen=True)
    assert rows(table) == rows(batch)
    # array length = days of the month processed so far
    assert table.where((F.col("month") == F.lit(dt.date(2024, 2, 1))) & (F.size("hit_array") != 3)).count() == 0


def test_metric_fold_equals_batch(spark):
    ev = views.events(spark, SF_TINY, shift_days=15)
    run = dt.date(2024, 2, 2)
    table = reduced.metric_build(ev, run - dt.timedelta(days=3))
    for k in range(2, -1, -1):
        d = run - dt.timedelta(days=k)
        table = sinks.upsert(table, reduced.metric_step(ev, table, d), ["user_id", "month_start", "metric_name"])
    assert rows(table) == rows(reduced.metric_build(ev, run))


def test_expand_arrays_of_different_lengths(spark):
    t = spark.createDataFrame([(1, dt.date(2023, 1, 1), "m", [1.0, 2.0, 3.0]), (2, dt.date(2023, 1, 1), "m", [10.0])], MT)
    assert rows(reduced.expand(t)) == [("m", dt.date(2023, 1, 1), 11.0), ("m", dt.date(2023, 1, 2), 2.0),
                                       ("m", dt.date(2023, 1, 3), 3.0)]
    assert len(rows(reduced.expand(t, positions=2))) == 2


def test_upsert_and_snapshot_partitions(spark):
    from dimfold.session import shared_dir
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(sinks.upsert(old, new, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    path = shared_dir(spark, "test_snap")
    snap = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "k int, date date")
    sinks.write_snapshot(snap, path, ["date"])
    again = spark.createDataFrame([(5, dt.date(2024, 1, 2))], "k int, date date")
    sinks.write_snapshot(again, path, ["date"])
    sinks.write_snapshot(again, path, ["date"])          # re-run: same result
    assert rows(sinks.read_snapshot(spark, path), "k", "date") == [(1, dt.date(2024, 1, 1)), (5, dt.date(2024, 1, 2))]


def test_upsert_rejects_a_key_that_comes_in_twice(spark):
    old = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        sinks.upsert(old, twice, ["k"]).collect()
    nulls = spark.createDataFrame([(None, "p"), (None, "q"), (1, "A")], "k int, v string")
    assert rows(sinks.upsert(old, nulls, ["k"])) == rows(spark.createDataFrame([(1, "A"), (None, "n"), (None, "p"), (None, "q")], "k int, v string"))
