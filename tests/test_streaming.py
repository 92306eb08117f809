import datetime as dt

from conftest import SF_TINY, rows
from dimfold.operators import dedup
from dimfold.session import shared_dir
from dimfold.sources import views
from dimfold.streaming import dedup as sd

EV = "event_id long, user_id long, device_id long, host string, event_type string, event_time timestamp_ntz"


def test_stream_dedup_equals_batch_dedup(spark):
    ev = views.events(spark, SF_TINY)
    landing = shared_dir(spark, "t_landing")
    ev.write.parquet(landing)
    out = sd.run_dedup(spark, landing, ev.schema, dedup.EVENT_KEY, "event_time", "1 hour",
                       shared_dir(spark, "t_out"), shared_dir(spark, "t_ckpt"))
    assert rows(out) == rows(dedup.dedup_events(ev))


def test_stream_dedup_across_micro_batches(spark):
    t0 = dt.datetime(2024, 1, 1, 12)
    landing = shared_dir(spark, "t_landing2")
    first = spark.createDataFrame([(1, 1, 1, "h", "v", t0), (2, 2, 1, "h", "v", t0 + dt.timedelta(hours=5))], EV)
    # a copy of event 2 (inside the delay) and a new event; the copy of event 1 is late (older than the watermark)
    second = spark.createDataFrame([(2, 2, 1, "h", "v", t0 + dt.timedelta(hours=5)),
                                    (1, 1, 1, "h", "v", t0),
                                    (3, 3, 1, "h", "v", t0 + dt.timedelta(hours=6))], EV)
    first.coalesce(1).write.parquet(landing + "/a")
    second.coalesce(1).write.parquet(landing + "/b")
    src = spark.createDataFrame([], EV)
    out = sd.run_dedup(spark, landing + "/*", src.schema, dedup.EVENT_KEY, "event_time", "1 hour",
                       shared_dir(spark, "t_out2"), shared_dir(spark, "t_ckpt2"), max_files_per_trigger=1)
    assert sorted(r.event_id for r in out.collect()) == [1, 2, 3]


def test_hourly_batch_form(spark):
    ev = views.events(spark, SF_TINY)
    a = sd.dedup_hourly_batch(ev, dedup.EVENT_KEY, "event_time")
    assert a.count() == ev.dropDuplicates(list(dedup.EVENT_KEY)).count()


def test_fold_on_arrival_equals_batch(spark):
    from pyspark.sql import functions as F

    from dimfold.operators import datelist
    from dimfold.plans.fold import latest
    from dimfold.plans.sinks import write_snapshot
    from dimfold.streaming.fold import fold_on_arrival

    ev = views.events(spark, SF_TINY)
    landing = shared_dir(spark, "t_fold_landing")
    days = [dt.date(2024, 1, d) for d in range(3, 9)]
    for d in days:                                   # one landed file per day, in order
        ev.where(F.to_date("event_time") == F.lit(d)).coalesce(1).write.mode("append").parquet(landing)
    table = shared_dir(spark, "t_fold_table")
    write_snapshot(datelist.dates_build(ev.where(F.to_date("event_time") >= F.lit(days[0])), days[0]), table, ["date"])

    def step(events, stored, day):
        return datelist.dates_step(events, latest(stored, "date", day - dt.timedelta(days=1)), day)

    out = fold_on_arrival(spark, landing, ev.schema, table, step, shared_dir(spark, "t_fold_ckpt"),
                          max_files_per_trigger=1)
    # the newest landed day is not complete yet: folded up to the day before it
    assert out.agg(F.max("date")).first()[0] == days[-2]
    expect = datelist.dates_build(ev.where(F.to_date("event_time") >= F.lit(days[0])), days[-2])
    assert rows(latest(out, "date", days[-2]).select(*expect.columns)) == rows(expect)
