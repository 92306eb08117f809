"""Late data: the hour tree, corrections of folds, and merges that rewrite only what they touch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY, rows
from dimfold.operators import datelist
from dimfold.plans import corrections, merge, sinks
from dimfold.session import shared_dir
from dimfold.sources import views
from dimfold.streaming import fold as stream_fold
from dimfold.streaming import hour_tree

EV = "event_id long, user_id long, device_id long, host string, event_type string, event_time timestamp_ntz"
KEYS = ["user_id", "device_id", "event_type"]
DAY = dt.datetime(2024, 1, 5)


def local(path):
    return path.removeprefix("file:")


def files_below(path):
    """File -> its bytes' time, for every data file below a folder."""
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(local(path)) for n in names if n.endswith(".parquet")}


def visits(spark, *items):
    """(event_id, user, hour, minute) of the day."""
    return spark.createDataFrame([(i, u, 1, "h", "view", DAY + dt.timedelta(hours=h, minutes=m)) for i, u, h, m in items], EV)


def by_hand(events):
    out = {}
    for r in events.collect():
        if r.event_time is None:
            continue
        k = (r.event_time.date(), r.user_id, r.device_id, r.event_type)
        out.setdefault(k, []).append((r.event_time, r.event_id))
    return sorted(((*k, *reversed(min(v)), len(v)) for k, v in out.items()), key=repr)


def tree_rows(spark, path):
    return rows(hour_tree.day_rows(spark, path), "day", *KEYS, "event_id", "event_time", "n_copies")


def test_hour_tree_equals_keyed_dedup(spark):
    ev = views.events(spark, SF_TINY)
    path = shared_dir(spark, "t_tree")
    hour_tree.update(spark, path, ev, hour_tree._hours(ev, "event_time"), KEYS)
    assert tree_rows(spark, path) == by_hand(ev)


def test_late_hour_rewrites_only_its_path(spark):
    landing, path = shared_dir(spark, "t_landing"), shared_dir(spark, "t_tree")
    first = visits(spark, (1, 1, 0, 5), (2, 1, 7, 0), (3, 2, 7, 1), (4, 2, 23, 0), (5, 3, 12, 0), (6, None, 12, 1), (7, None, 13, 1))
    first.write.parquet(landing)
    landed = lambda: spark.read.schema(first.schema).parquet(landing)
    written = hour_tree.update(spark, path, landed(), hour_tree._hours(first, "event_time"), KEYS)
    assert written[0] == [(DAY.date(), h) for h in (0, 7, 12, 13, 23)] and written[-1] == [(DAY.date(), 0)]
    before = files_below(path)
    late = visits(spark, (8, 3, 6, 30), (9, 1, 6, 31), (8, 3, 6, 30))
    late.write.mode("append").parquet(landing)
    written = hour_tree.update(spark, path, landed(), hour_tree._hours(late, "event_time"), KEYS)
    assert [n for _, n in (w for level in written for w in level)] == [6, 3, 1, 0, 0, 0]            # one node a level
    after = files_below(path)
    kept = {f for f in before if after.get(f) == before[f]}
    gone = {f for f in before if f not in kept}
    assert all(any(f"level={lv}/" in f and f"node={n}/" in f for lv, n in ((1, 3), (2, 1), (3, 0), (4, 0), (5, 0))) for f in gone)
    assert {"level=0/day=2024-01-05/node=7", "level=1/day=2024-01-05/node=6"} <= {os.path.dirname(f).split("/", local(path).count("/") + 1)[-1] for f in kept}
    assert tree_rows(spark, path) == by_hand(landed())
    hour_tree.update(spark, path, landed(), hour_tree._hours(late, "event_time"), KEYS)              # again: the same
    assert tree_rows(spark, path) == by_hand(landed())
    assert hour_tree.update(spark, path, landed(), [], KEYS) == []


def test_hour_tree_on_arrival(spark):
    landing, path = shared_dir(spark, "t_landing"), shared_dir(spark, "t_tree")
    parts = [visits(spark, (1, 1, 3, 0), (2, 2, 4, 0)), visits(spark, (3, 1, 2, 59)), visits(spark, (4, 2, 4, 0), (5, 5, 23, 59))]
    for p in parts:
        p.coalesce(1).write.mode("append").parquet(landing)
    out = hour_tree.tree_on_arrival(spark, landing, parts[0].schema, path, KEYS, shared_dir(spark, "t_ckpt"), max_files_per_trigger=1)
    assert rows(out, "day", *KEYS, "event_id", "event_time", "n_copies") == by_hand(spark.read.parquet(landing))


def test_hot_hour_and_key(spark):
    ev = spark.range(6000).selectExpr("id as event_id", "if(id % 3 = 0, 1, id) as user_id", "1L as device_id", "'h' as host", "'view' as event_type",
                                      "timestamp_ntz'2024-01-05 08:00:00' + make_dt_interval(0, 0, 0, id % 50) as event_time")
    path = shared_dir(spark, "t_tree")
    hour_tree.update(spark, path, ev, [(DAY.date(), 8)], KEYS)
    assert tree_rows(spark, path) == by_hand(ev)


# ------------------------------------------------------------------ corrections

def _days(ev, lo, hi):
    return ev.where(F.to_date("event_time").between(F.lit(lo), F.lit(hi)))


def test_late_events_correct_later_snapshots_of_their_users_only(spark):
    ev = views.events(spark, SF_TINY).where("user_id is not null")
    first, last = dt.date(2024, 1, 10), dt.date(2024, 1, 14)
    late_rows = ev.where((F.pmod("user_id", F.lit(7)) == 3) & (F.to_date("event_time") == F.lit(dt.date(2024, 1, 11))))
    late_rows = late_rows.unionByName(spark.createDataFrame([(-1, 999_999, 1, "h", "view", dt.datetime(2024, 1, 12, 3))], EV))
    all_events = ev.unionByName(late_rows.where("event_id < 0"))
    on_time = ev.join(late_rows, ["event_id"], "left_anti")
    path = shared_dir(spark, "t_fold")
    for k in range(5):
        corrections.write_day(datelist.dates_build(on_time, first + dt.timedelta(days=k)), path)
    snapshots = files_below(path)
    late = corrections.late_entities(late_rows, last, ["user_id"])
    days = corrections.replay(spark, path, all_events, late, datelist.dates_step, datelist.dates_build, {"user_id": "user_id"}, batch=1)
    assert days == 4                                                          # from the earliest late day to the newest
    after = files_below(path)
    assert all(after[f] == t for f, t in snapshots.items())                    # no snapshot file was touched
    users = {str(r.user_id) for r in late.select("user_id").distinct().collect()}
    fixes = spark.read.option("basePath", path).parquet(path).where("fix > 0")
    assert {r.user_id for r in fixes.select("user_id").distinct().collect()} == users
    got = corrections.corrected(spark, path, ["user_id"])
    before = rows(got)
    for k in range(5):
        d = first + dt.timedelta(days=k)
        want = datelist.dates_build(all_events, d)
        assert rows(got.where(F.col("date") == F.lit(d)), *want.columns) == rows(want)
    again = corrections.replay(spark, path, all_events, late, datelist.dates_step, datelist.dates_build, {"user_id": "user_id"}, batch=1)
    assert again == 4 and rows(corrections.corrected(spark, path, ["user_id"])) == before
    want = rows(corrections.corrected(spark, path, ["user_id"], days=[last]))
    corrections.compact(spark, path, ["user_id"], last)
    table = spark.read.option("basePath", path).parquet(path)
    assert table.where((F.col("date") == F.lit(last)) & (F.col("fix") > 0)).count() == 0
    assert rows(corrections.corrected(spark, path, ["user_id"], days=[last])) == want


def test_late_events_before_the_first_snapshot(spark):
    ev = spark.createDataFrame([(i, u, 1, "h", "view", dt.datetime(2024, 1, d)) for i, (u, d) in enumerate([(1, 5), (1, 7), (2, 6), (3, 8)])], EV)
    path = shared_dir(spark, "t_fold")
    for d in (6, 7, 8):
        corrections.write_day(datelist.dates_build(ev, dt.date(2024, 1, d)), path)
    late_rows = spark.createDataFrame([(9, 2, 1, "h", "view", dt.datetime(2024, 1, 2)), (10, None, 1, "h", "view", dt.datetime(2024, 1, 7))], EV)
    late = corrections.late_entities(late_rows, dt.date(2024, 1, 8), ["user_id"])
    everything = ev.unionByName(late_rows)
    assert corrections.replay(spark, path, everything, late, datelist.dates_step, datelist.dates_build, {"user_id": "user_id"}, batch=4) == 3
    for d in (6, 7, 8):
        want = datelist.dates_build(everything, dt.date(2024, 1, d))
        assert rows(corrections.corrected(spark, path, ["user_id"], days=[dt.date(2024, 1, d)]), *want.columns) == rows(want)
    assert corrections.replay(spark, path, everything, late.where("user_id < 0"), datelist.dates_step, datelist.dates_build, {"user_id": "user_id"}, 5) == 0


def test_hosts_fold_is_corrected_too(spark):
    """The same replay for the host lists: the entity is the host, the step counts again."""
    ev = views.events(spark, SF_TINY)
    late = F.minute("event_time") == 31
    path = shared_dir(spark, "t_hosts")
    days = [dt.date(2024, 1, d) for d in (8, 9, 10)]
    for d in days:
        corrections.write_day(datelist.host_build(ev.where(~late), d), path)
    who = corrections.late_entities(ev.where(late & (F.to_date("event_time") == F.lit(days[1]))), days[-1], ["host"])
    now = ev.where(~late | (F.to_date("event_time") == F.lit(days[1])))
    corrections.replay(spark, path, now, who, datelist.host_step, datelist.host_build, {"host": "host"}, batch=1)
    for d in days:
        want = datelist.host_build(now, d)
        assert rows(corrections.corrected(spark, path, ["host"], days=[d]), *want.columns) == rows(want)


def test_fold_with_corrections_gives_the_batch_result(spark):
    ev = views.events(spark, SF_TINY)
    landing, path, log = shared_dir(spark, "t_landing"), shared_dir(spark, "t_fold"), shared_dir(spark, "t_log")
    start = dt.date(2024, 1, 3)
    late = F.minute("event_time") == 31
    for d in range(3, 9):
        ev.where(~late & (F.to_date("event_time") == F.lit(dt.date(2024, 1, d)))).coalesce(1).write.mode("append").parquet(landing)
    _days(ev.where(late), dt.date(2024, 1, 1), dt.date(2024, 1, 8)).coalesce(1).write.mode("append").parquet(landing)
    corrections.write_day(datelist.dates_build(ev.where(~late & (F.to_date("event_time") == F.lit(start))), start), path)
    out = stream_fold.fold_with_corrections(spark, landing, ev.schema, path, log, datelist.dates_step, datelist.dates_build,
                                            {"user_id": "user_id"}, shared_dir(spark, "t_ckpt"), max_files_per_trigger=1)
    landed = spark.read.schema(ev.schema).parquet(landing)
    assert out.agg(F.max("date")).first()[0] == dt.date(2024, 1, 7)
    for d in range(3, 8):
        want = datelist.dates_build(landed, dt.date(2024, 1, d))
        assert rows(out.where(F.col("date") == F.lit(dt.date(2024, 1, d))), *want.columns) == rows(want)
    logged = spark.read.option("basePath", log).parquet(log)
    assert logged.where(F.col("late_day") <= F.lit(dt.date(2024, 1, 7))).count() > 0


# ------------------------------------------------------------------ merge

TABLE = "k long, j string, v string"


def test_merge_rewrites_touched_buckets_only(spark):
    path = shared_dir(spark, "t_merge")
    base = spark.range(400).selectExpr("id as k", "cast(id % 3 as string) as j", "concat('old', id) as v")
    merge.create(base, path, ["k", "j"], buckets=16)
    before = files_below(path)
    _, first = merge.manifest(spark, path)
    incoming = spark.createDataFrame([(7, "1", "new"), (7, "9", "added"), (1000, "x", None)], TABLE)
    touched = merge.merge(incoming, path)
    after = files_below(path)
    assert 1 <= len(touched) <= 3 and all(after[f] == t for f, t in before.items())           # nothing is written in place
    _, second = merge.manifest(spark, path)
    changed = {b for b in second["folders"] if second["folders"][b] != first["folders"].get(b)}
    assert changed == {str(b) for b in touched}
    want = rows(sinks.upsert(base, incoming, ["k", "j"]))
    assert rows(merge.read(spark, path)) == want and rows(merge.read(spark, path, 1)) == rows(base)
    plan = merge.read(spark, path).inputFiles()
    assert not any(first["folders"][b] in f for f in plan for b in changed if b in first["folders"])
    assert merge.vacuum(spark, path) == len([b for b in changed if b in first["folders"]])
    assert rows(merge.read(spark, path)) == want
    with pytest.raises(Exception):  # noqa: B017
        merge.manifest(spark, path, 1)


def test_a_merge_that_stops_before_its_switch_leaves_the_old_table(spark, monkeypatch):
    path = shared_dir(spark, "t_merge")
    base = spark.createDataFrame([(i, "a", "old") for i in range(50)], TABLE)
    merge.create(base, path, ["k"], buckets=4)
    incoming = spark.createDataFrame([(1, "b", "new")], TABLE)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(merge, "_switch", stop)
        with pytest.raises(RuntimeError):
            merge.merge(incoming, path)
    assert rows(merge.read(spark, path)) == rows(base)
    merge.merge(incoming, path)                                                              # the next run is not disturbed
    assert merge.read(spark, path).where("v = 'new'").count() == 1 and merge.read(spark, path).count() == 50


def test_of_two_merges_at_once_one_fails_and_loses_nothing(spark):
    path = shared_dir(spark, "t_merge")
    merge.create(spark.createDataFrame([(1, "a", "old")], TABLE), path, ["k"], buckets=2)
    version, content = merge.manifest(spark, path)
    merge.merge(spark.createDataFrame([(2, "a", "one")], TABLE), path)
    with pytest.raises(merge.MergeConflict):
        merge._switch(spark, path, version + 1, content)
    assert merge.read(spark, path).count() == 2


def test_merge_edge_cases(spark):
    path = shared_dir(spark, "t_merge")
    empty = spark.createDataFrame([], TABLE)
    merge.create(empty, path, ["k"], buckets=4)
    assert merge.read(spark, path).count() == 0 and merge.merge(empty, path) == []
    merge.merge(spark.createDataFrame([(None, "n", "1"), (None, "n", "2"), (3, "n", "3")], TABLE), path)
    assert merge.read(spark, path).count() == 3                                              # null keys never conflict
    with pytest.raises(Exception, match="more than once"):
        merge.merge(spark.createDataFrame([(3, "x", "1"), (3, "x", "2")], TABLE), path)
    assert merge.read(spark, path).where("k = 3").first().v == "3"
    with pytest.raises(ValueError):
        merge.create(empty.withColumnRenamed("j", "bucket"), shared_dir(spark, "t_merge"), ["k"])
    with pytest.raises(FileNotFoundError):
        merge.read(spark, shared_dir(spark, "t_merge"))
