from pyspark.sql import functions as F

from conftest import SF_TINY, rows
from dimfold.operators import history, scd
from dimfold.sources import views

SNAP = "actor_id string, actor_name string, year int, quality_class string, is_active boolean"


def _snaps(spark, data):
    return spark.createDataFrame(data, SNAP)


def test_scd2_null_safe_streaks(spark):
    s = _snaps(spark, [
        ("a", "A", 1, None, True), ("a", "A", 2, None, True),      # NULL on both sides: same streak
        ("a", "A", 3, "good", True), ("a", "A", 4, None, True),  # value -> NULL -> value
        ("a", "A", 5, "good", True),
    ])
    got = rows(scd.scd2_full(s, 5), "quality_class", "start_year", "end_year")
    assert got == sorted([(None, 1, 2), ("good", 3, 3), (None, 4, 4), ("good", 5, 5)], key=repr)


def test_scd2_invariants_and_incremental_equals_full(spark):
    actors = history.history_backfill_avg(views.actor_films(spark, SF_TINY))
    full = scd.scd2_full(actors, 2000)
    # contiguous, non-overlapping ranges; one open row per entity
    w = full.groupBy("actor_id").agg(F.sum(F.col("end_year") - F.col("start_year") + 1).alias("n"),
                                     F.min("start_year").alias("lo"), F.max("end_year").alias("hi"),
                                     F.count_if(F.col("end_year") == 2000).alias("open"))
    assert w.where("n != hi - lo + 1 or open != 1").count() == 0
    inc = scd.scd2_incremental(full, actors, 2000, 2001)
    assert rows(inc) == rows(scd.scd2_full(actors, 2001))


def test_scd2_branches(spark):
    prev = spark.createDataFrame([
        ("u", "U", "good", True, 1, 3, 3), ("c", "C", "good", True, 2, 3, 3),
        ("m", "M", "bad", True, 1, 3, 3), ("h", "H", "bad", True, 1, 1, 3), ("h", "H", "good", True, 2, 3, 3),
        ("n", "N", None, True, 3, 3, 3),
    ], "actor_id string, actor_name string, quality_class string, is_active boolean, start_year int, "
       "end_year int, current_year int")
    snap = _snaps(spark, [("u", "U", 4, "good", True), ("c", "C", 4, "star", True), ("x", "X", 4, "bad", True),
                          ("h", "H", 4, "good", True), ("n", "N", 4, None, True)])
    br = {r.actor_id: r.branch for r in scd.scd2_branches(prev, snap, 3, 4).collect()}
    assert br == {"u": "unchanged", "c": "changed", "m": "missing", "x": "new", "h": "unchanged", "n": "unchanged"}
    out = rows(scd.scd2_incremental(prev, snap, 3, 4), "actor_id", "quality_class", "start_year", "end_year")
    assert out == sorted([("u", "good", 1, 4), ("c", "good", 2, 3), ("c", "star", 4, 4), ("m", "bad", 1, 3),
                          ("h", "bad", 1, 1), ("h", "good", 2, 4), ("x", "bad", 4, 4), ("n", None, 3, 4)], key=repr)
    dropped = scd.scd2_branches(prev, snap, 3, 4, on_missing="drop")
    assert dropped.where("actor_id = 'm'").count() == 0


def test_scd_types_and_as_of(spark):
    s = _snaps(spark, [("a", "A", 1, "bad", True), ("a", "A", 2, "good", True), ("a", "A", 3, "star", True)])
    assert scd.scd_type0(s, "actor_id", "year", ["quality_class"]).first().quality_class == "bad"
    t1 = scd.scd_type1(s, "actor_id", "year", ["quality_class"]).first()
    assert (t1.quality_class, t1.year) == ("star", 3)
    t3 = scd.scd_type3(s, "actor_id", "year", ["quality_class"]).first()
    assert (t3.original_quality_class, t3.current_quality_class) == ("bad", "star")
    full = scd.scd2_full(s, 3)
    assert scd.scd2_as_of(full, 2).first().quality_class == "good"
    assert rows(scd.scd2_expand(full), "year", "quality_class") == [(1, "bad"), (2, "good"), (3, "star")]


def test_scd2_join_as_of(spark):
    s = _snaps(spark, [("a", "A", 1, "bad", True), ("a", "A", 2, "good", True), ("a", "A", 3, "good", True)])
    full = scd.scd2_full(s, 3)
    facts = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("b", 2, 5)], "actor_id string, year int, v int")
    out = rows(scd.scd2_join_as_of(facts, full), "actor_id", "year", "quality_class")
    assert out == sorted([("a", 1, "bad"), ("a", 3, "good"), ("b", 2, None)], key=repr)
