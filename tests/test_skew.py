"""One key holding a third of all rows: results stay exact and hot keys are cut before the shuffle."""

import datetime as dt
import re

from pyspark.sql import functions as F

from conftest import rows
from dimfold.operators import datelist, dedup, graph
from dimfold.plans import inspect

EV = "event_id long, user_id long, device_id long, host string, event_type string, event_time timestamp_ntz"


def _skewed_events(spark, n=3000):
    t0 = dt.datetime(2024, 1, 1)
    data = []
    for i in range(n):
        hot = i % 3 == 0
        user = 1 if hot else 100 + i % 97
        host = "hot" if hot else f"h{i % 13}"
        ts = t0 + dt.timedelta(minutes=17 * i)
        data.append((i, user, i % 11, host, "view", ts))
        if i % 10 == 0:
            data.append((i, user, i % 11, host, "view", ts))  # re-delivered copy
    return spark.createDataFrame(data, EV)


def test_hot_key_dedup_is_cut_map_side(spark):
    ev = _skewed_events(spark)
    out = dedup.dedup_events(ev)
    assert out.count() == 3000
    plan = inspect.plan_text(out, "simple")
    # partial limit below the exchange, final one above it
    assert re.search(r"WindowGroupLimit .*Final.*\n(.*\n)*?.*Exchange(.*\n)*?.*WindowGroupLimit .*Partial", plan)


def test_hot_user_and_host_counts(spark):
    ev = _skewed_events(spark)
    run = dt.date(2024, 2, 5)
    users = {r.user_id: r for r in datelist.dates_build(ev, run).collect()}
    hot_days = ev.where("user_id = 1").select(F.to_date("event_time")).distinct().count()
    assert len(users["1"].dates_active) == hot_days
    counts = datelist.host_day_counts(ev, F.lit(True)).where("host = 'hot'")
    total = counts.agg(F.sum("events_count")).first()[0]
    assert total == 1000                                   # copies removed, every hot event counted once


def test_hot_game_pair_edges_exact(spark):
    schema = "game_id long, team_id int, team_abbreviation string, player_id long, player_name string, " \
             "start_position string, pts int"
    hot = [(1, p % 2, f"T{p % 2}", p, f"P{p}", None, p) for p in range(60)]
    small = [(g, 0, "T0", p, f"P{p}", None, 1) for g in range(2, 32) for p in (100 + g % 5, 101 + g % 5)]
    e = graph.pair_edges(spark.createDataFrame(hot + small, schema))
    assert e.count() == 60 * 59 // 2 + 5                   # every pair of the hot game once, 5 small pairs
    assert e.where("edge_type = 'shares_team'").count() == 2 * (30 * 29 // 2) + 5
    assert e.where(F.col("subject_identifier").cast("long") <= F.col("object_identifier").cast("long")).count() == 0
    small_pair = e.where("subject_identifier = '101' and object_identifier = '100'").first()
    assert '"num_games":6' in small_pair.properties         # games 5, 10, ..., 30
