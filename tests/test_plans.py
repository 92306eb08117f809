"""Plan shape: no cartesian products, pushed filters, one exchange where the design says one."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL, SF_TINY
from dimfold.operators import bucketize, datelist, history, scd
from dimfold.plans import inspect, sinks
from dimfold.session import shared_dir
from dimfold.sources import views


def test_backfills_have_no_theta_or_cross_join(spark):
    ps = views.player_seasons(spark, SF_TINY)
    assert not inspect.has_cartesian(history.history_backfill(ps, 1995, 2001))
    assert not inspect.has_cartesian(history.history_backfill_avg(views.actor_films(spark, SF_TINY)))
    snap = datelist.dates_build(views.events(spark, SF_TINY), dt.date(2024, 1, 30))
    bm = datelist.datelist_bitmap(snap)
    assert not inspect.has_cartesian(bm)


def test_day_filter_reaches_the_scan(spark):
    ev = views.events(spark, SF_TINY)
    step = datelist.user_days(ev, dt.date(2024, 1, 30))
    pushed = " ".join(inspect.pushed_filters(step))
    assert "ts" in pushed and ("GreaterThanOrEqual" in pushed or "LessThan" in pushed)


def test_scd2_full_single_exchange(spark):
    snaps = spark.createDataFrame([("a", "A", 1, "x", True)],
                                  "actor_id string, actor_name string, year int, quality_class string, is_active boolean")
    assert inspect.exchanges(scd.scd2_full(snaps, 1)) == 1


def test_bucketed_aggregate_has_no_exchange(spark):
    gd = views.game_details(spark, SF_TINY)
    path = shared_dir(spark, "t_bucketed")
    name = "t_bucketed_" + path.rsplit("/", 1)[-1]
    sinks.write_bucketed(gd, name, 4, ["player_id"], path)
    agg = spark.table(name).groupBy("player_id").agg(F.sum("pts"))
    assert inspect.exchanges(agg) == 0


def test_bucketize_is_balanced(spark):
    o = views.read_table(spark, SF_SMALL, "orders", ["o_orderkey", "o_totalprice"])
    b = bucketize.bucketize(o, "o_totalprice", 5)
    sizes = [r["count"] for r in b.groupBy("bucket").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) < 0.02 * sum(sizes)
    # monotone: every value of bucket i is below every value of bucket i+1
    ranges = b.groupBy("bucket").agg(F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")) \
              .orderBy("bucket").collect()
    assert all(ranges[i].hi < ranges[i + 1].lo for i in range(4))


def test_scd2_step_on_bucketed_tables_needs_no_exchange(spark):
    """Co-located storage: SCD rows and snapshots bucketed by the entity key join without a shuffle."""
    snaps = history.history_backfill_avg(views.actor_films(spark, SF_TINY), with_films=False)
    full = scd.scd2_full(snaps, 2000)
    tag = shared_dir(spark, "t_colocated").rsplit("/", 1)[-1]
    sinks.write_bucketed(full, f"scd_{tag}", 8, ["actor_id"], shared_dir(spark, "t_scd_b"))
    sinks.write_bucketed(snaps, f"snap_{tag}", 8, ["actor_id"], shared_dir(spark, "t_snap_b"))
    step = scd.scd2_incremental(spark.table(f"scd_{tag}"), spark.table(f"snap_{tag}"), 2000, 2001)
    assert inspect.exchanges(step) == 0
    assert step.count() == scd.scd2_incremental(full, snaps, 2000, 2001).count()
