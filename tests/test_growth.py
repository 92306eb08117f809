"""Operators that stay bounded as an entity, a game or a table grows: segments, as-of merges, key filters, sketches, bitmaps."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY, rows
from dimfold.operators import as_of, bucketize, datelist, graph, history, key_filter, scd, segments
from dimfold.plans import fold, inspect
from dimfold.plans.sinks import upsert
from dimfold.session import shared_dir
from dimfold.sources import views

DETAILS = "game_id long, team_id int, team_abbreviation string, player_id long, player_name string, start_position string, pts int"


# ------------------------------------------------------------------ segments

def credits(spark, n=3000):
    """Actor 1 holds a third of all credits."""
    return spark.range(n).selectExpr("if(id % 3 = 0, '1', cast(2 + id % 97 as string)) as actor_id", "cast(1990 + id % 17 as int) as year",
                                     "cast(id as string) as filmid", "cast(id % 100 as double) as pts")


def listed(r):
    return [(x.year, x.filmid) for x in r["items"]]


def test_a_hot_entity_makes_no_row_over_the_bound(spark):
    films = credits(spark)
    seg = segments.build(films, "actor_id", ["year", "filmid"], ["pts"], bound=50).collect()
    assert max(r.n_items for r in seg) == 50 and all(r.n_items == len(r["items"]) for r in seg)
    want = {}
    for r in sorted(films.collect(), key=lambda r: (r.year, r.filmid)):
        want.setdefault(r.actor_id, []).append((r.year, r.filmid))
    got = {}
    for r in sorted(seg, key=lambda r: (r.actor_id, r.segment)):
        assert r.first == r["items"][0].year and r.last == r["items"][-1].year
        got.setdefault(r.actor_id, []).extend(listed(r))
    assert got == want
    assert sorted(r.segment for r in seg if r.actor_id == "1") == list(range(20))


def test_append_changes_open_segments_only(spark):
    films = credits(spark, 900)
    order, items = ["year", "filmid"], ["pts"]
    old = segments.build(films.where("year < 2000"), "actor_id", order, items, bound=20)
    later = films.where("year >= 2000 and actor_id in ('1', '5', '40')")
    more = segments.append(old, later, "actor_id", order, items, bound=20)
    last = {r.actor_id: r.s for r in old.groupBy("actor_id").agg(F.max("segment").alias("s")).collect()}
    assert all(r.segment >= last[r.actor_id] for r in more.collect()) and {r.actor_id for r in more.collect()} == {"1", "5", "40"}
    whole = segments.build(films.where("year < 2000 or actor_id in ('1', '5', '40')"), "actor_id", order, items, bound=20)
    key = lambda df: sorted((r.actor_id, r.segment, r.n_items, listed(r)) for r in df.collect())
    assert key(upsert(old, more, ["actor_id", "segment"])) == key(whole)
    new = segments.append(old, spark.createDataFrame([("new", 2010, "f", 1.0)], films.schema), "actor_id", order, items, bound=20)
    assert key(new) == [("new", 0, 1, [(2010, "f")])]


def test_reads_over_segments_equal_reads_over_arrays(spark):
    ps = views.player_seasons(spark, SF_TINY)
    seg = segments.build(ps, "player_name", ["season"], ["gp", "pts", "reb", "ast"], bound=2)
    snap = history.history_backfill(ps, 1990, 2001).where("current_season = 2001")
    flat = segments.explode(seg, "player_name", 2001, "season")
    cols = ["player_name", "season", "gp", "pts", "reb", "ast"]
    assert rows(flat, *cols) == rows(history.history_explode(snap), *cols)
    ends = segments.first_last(seg.where("first <= 2001"), "player_name", "pts")
    assert ends.count() == snap.count()
    whole = segments.first_last(segments.build(ps.where("season <= 2001"), "player_name", ["season"], ["pts"], bound=2), "player_name", "pts")
    got = rows(whole.select("player_name", "first_value", "last_value", F.col("n_items").cast("int"), "growth"))
    assert got == rows(history.history_first_last(snap))


# ------------------------------------------------------------------ as-of merge

def test_as_of_merge_equals_the_join(spark):
    rng = random.Random(4)
    versions, facts = [], []
    for k in range(40):
        t = rng.randrange(50)
        for _ in range(rng.randrange(6)):
            end = t + rng.randrange(4)
            versions.append((f"k{k}", t, end, rng.choice("abc"), rng.random() < 0.5))
            t = end + 1 + rng.randrange(3)
        facts += [(f"k{k}", rng.choice([None, *range(70)]), i) for i in range(rng.randrange(30))]
    facts += [(None, 5, 1), ("none", 5, 2), ("k1", 20, 3), ("k1", 20, 3)]
    v = spark.createDataFrame(versions, "actor_id string, start_year int, end_year int, quality_class string, is_active boolean")
    f = spark.createDataFrame(facts, "actor_id string, year int, n int")
    want = rows(scd.scd2_join_as_of(f, v), "actor_id", "year", "n", "quality_class", "is_active")
    for chunk in (1, 3, 1000):                                  # every key cut into many slices and salts, some, none
        got = as_of.merge_as_of(f, v, "actor_id", "year", "start_year", "end_year", ["quality_class", "is_active"], chunk=chunk)
        assert rows(got, "actor_id", "year", "n", "quality_class", "is_active") == want


def test_as_of_merge_of_many_versions_is_linear(spark):
    """100,000 versions and as many facts of one entity: the equi-join would compare ten billion pairs."""
    n = 100_000
    v = spark.range(n).selectExpr("concat('hot', id % 1) as k", "id * 10 as s", "id * 10 + 7 as e", "id as a")
    f = spark.range(n).selectExpr("concat('hot', id % 1) as k", "id * 10 + id % 10 as t", "id as n")
    got = as_of.merge_as_of(f, v, "k", "t", "s", "e", ["a"], chunk=20_000)
    assert got.where("(n % 10 <= 7 and a = n) or (n % 10 > 7 and a is null)").count() == n
    assert not inspect.has_cartesian(got) and "Join" in inspect.plan_text(got, "simple")


def test_as_of_merge_on_dates_with_open_ends(spark):
    d = lambda x: dt.date(2024, 1, x)
    v = spark.createDataFrame([("a", d(3), d(5), "one"), ("a", d(6), None, "two")], "k string, s date, e date, x string")
    f = spark.createDataFrame([("a", d(2)), ("a", d(3)), ("a", d(5)), ("a", d(6)), ("a", d(30)), ("b", d(4))], "k string, t date")
    got = as_of.merge_as_of(f, v, "k", "t", "s", "e", ["x"], as_number=F.unix_date)
    assert sorted((r.k, r.t.day, r.x) for r in got.collect()) == [("a", 2, None), ("a", 3, "one"), ("a", 5, "one"), ("a", 6, "two"), ("a", 30, "two"), ("b", 4, None)]
    assert as_of.merge_as_of(f, v.where("k = 'z'"), "k", "t", "s", "e", ["x"], as_number=F.unix_date).where("x is not null").count() == 0


# ------------------------------------------------------------------ key filters

def test_key_filter_has_no_false_negative_and_few_false_positives(spark):
    keys = ["a", "b"]
    held = spark.range(3000).selectExpr("id as a", "cast(id % 7 as string) as b")
    bits = key_filter.bits_for(3000)
    filt = key_filter.build_filter(held, keys, bits).cache()
    assert key_filter.may_hold(held, filt, keys, bits).count() == 3000
    other = spark.range(10_000, 13_000).selectExpr("id as a", "cast(id % 7 as string) as b")
    assert key_filter.may_hold(other, filt, keys, bits).count() < 150


def test_key_guard_over_partitions(spark):
    guard = key_filter.KeyGuard(spark, shared_dir(spark, "t_guard"), ["k", "j"], expected_keys=100)
    schema = "k long, j string"
    found = lambda data, name: sorted(map(tuple, guard.add(spark.createDataFrame(data, schema), name).collect()), key=repr)
    assert found([(1, "a"), (2, "a"), (2, "a"), (None, "x")], "p0") == sorted([(2, "a", "duplicate", "p0"), (None, "x", "null_key", "p0")], key=repr)
    assert found([(3, "a"), (1, "b")], "p1") == []
    assert found([(1, "a"), (3, "a"), (4, "a"), (None, "x")], "p2") == sorted([(1, "a", "seen_before", "p0"), (3, "a", "seen_before", "p1"), (None, "x", "null_key", "p2")], key=repr)
    assert found([(1, "a"), (3, "a"), (4, "a")], "p2") == [(1, "a", "seen_before", "p0"), (3, "a", "seen_before", "p1")]     # the same again
    assert found([], "p3") == [] and found([(4, "a")], "p4") == [(4, "a", "seen_before", "p2")]


def test_key_lookup_is_one_join_row_a_key(spark):
    held = spark.range(50).selectExpr("id as a", "'x' as b")
    bits = key_filter.bits_for(50)
    plan = inspect.plan_text(key_filter.may_hold(held, spark.createDataFrame([], "number long, bitmap binary"), ["a", "b"], bits), "simple")
    assert "Generate" not in plan and "Aggregate" not in plan


def test_filters_of_a_growing_table_are_sized_for_all_its_keys(spark, tmp_path, monkeypatch):
    from dimfold import registry

    n, guards = 12_000, []
    one = spark.range(n).selectExpr("id as event_id", "timestamp_ntz'2024-01-01 00:30:00' + make_dt_interval(cast(id % 11 as int)) as ts", "id as user_id",
                                    "'view' as event_type", "1.0D as value", "'{\"k\": 1}' as props")
    again = spark.range(5).selectExpr("id + 100000 as event_id", "timestamp_ntz'2024-01-12 00:30:00' as ts", "id * 11 as user_id", "'view' as event_type",
                                      "1.0D as value", "'{\"k\": 1}' as props")
    one.unionByName(again).write.parquet(f"{tmp_path}/events.parquet")
    real = key_filter.KeyGuard
    monkeypatch.setattr(key_filter, "KeyGuard", lambda *a, **k: guards.append(real(*a, **k)) or guards[-1])
    got = registry.queries()["key_contract_partitions"](spark, str(tmp_path))
    assert rows(got, "checked", "violation", "held_by", "n_keys") == [("slice-2", "seen_before", "slice-0", 5)]
    assert guards[0].bits >= n * key_filter.BITS_PER_KEY
    filters = guards[0]._filters().agg(F.sum(F.bitmap_count("bitmap"))).first()[0]
    assert filters < guards[0].bits / 2                                # most bits are free: a new key is ruled out


# ------------------------------------------------------------------ pairs of a heavy game

def test_heavy_games_in_blocks_equal_light_ones(spark):
    data = [(1, p % 3, f"T{p % 3}", p, f"P{p}", None, p) for p in range(90)] + [(2, 0, "T0", p, f"P{p}", None, 1) for p in range(80, 95)]
    d = spark.createDataFrame(data, DETAILS)
    plain = rows(graph.pair_edges(d))
    assert len(plain) > 4000
    for heavy in (1, 7, 20, 89):
        assert rows(graph.pair_edges(d, heavy=heavy)) == plain


def test_a_game_of_4000_players_is_cut(spark):
    d = spark.range(4000).selectExpr("1L as game_id", "cast(id % 2 as int) as team_id", "cast(id % 2 as string) as team_abbreviation", "id as player_id",
                                     "'x' as player_name", "cast(null as string) as start_position", "1 as pts")
    e = graph.pair_edges(d)
    assert e.count() == 4000 * 3999 // 2
    cells = graph._heavy_pairs(d.withColumn("blocks", F.lit(16)))
    per_cell = cells.groupBy("a.lo", "a.hi").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert per_cell[1] == 136 and per_cell[0] < 3 * (4000 * 3999 // 2) / 136        # pairs of a cell near the mean


def test_typed_properties_equal_json_reads(spark):
    d = spark.createDataFrame([(1, 1, "A", 10, 'S"am', "C", 5), (2, 2, "B", 10, 'S"am', None, 9), (1, 1, "A", 11, "Kim", None, None), (2, 1, "A", 12, None, None, 0)], DETAILS)
    v, plays, pairs = graph.player_vertices(d), graph.plays_in_edges(d), graph.pair_edges(d)
    tv = graph.typed_properties(v, graph.PLAYER_PROPERTIES)
    assert rows(graph.max_typed_property(tv, graph.typed_properties(plays, graph.PLAYS_IN_PROPERTIES))) == rows(graph.max_property(v, plays))
    assert rows(graph.typed_pair_vs_career(tv, graph.typed_properties(pairs, graph.PAIR_PROPERTIES))) == rows(graph.pair_vs_career(v, pairs))
    odd = spark.createDataFrame([("1", "t", None), ("2", "t", "{}"), ("3", "t", "no json"), ("4", "t", '{"pts": "x"}')], "identifier string, type string, properties string")
    assert [r.p_pts for r in graph.typed_properties(odd, {"pts": "int"}).orderBy("identifier").collect()] == [None] * 4


def test_stored_reads_do_not_parse_json(spark):
    from dimfold import registry

    for key in ("graph_max_property", "graph_pair_vs_career"):
        plan = inspect.plan_text(registry.queries()[key](spark, SF_TINY), "extended")
        assert "get_json_object" not in plan and "variant_get" not in plan and "parse_json" not in plan


def test_box_scores_are_deduplicated_once(spark, monkeypatch):
    from dimfold import registry

    calls, real = [], graph.player_game_rows
    monkeypatch.setattr(graph, "player_game_rows", lambda d: calls.append(1) or real(d))
    for key in ("graph_edges_pairwise", "key_contract_built"):
        calls.clear()
        registry.queries()[key](spark, SF_TINY)
        assert len(calls) == 1


def test_edge_bags_are_parsed_once_a_row(spark):
    from dimfold import registry

    plan = inspect.plan_text(registry.queries()["graph_edges_pairwise"](spark, SF_TINY), "simple")
    assert "get_json_object" not in plan and plan.count("json_tuple") == 1


def test_box_scores_are_sorted_by_game_first(spark):
    d = spark.createDataFrame([(1, 1, "A", 10, "Sam", "C", 5), (1, 1, "A", 10, "Sam", "C", 3), (2, 1, "A", 10, "Sam", None, 4), (None, 1, "A", 10, "Sam", "C", 1),
                               (None, 1, "A", 10, "Sam", "C", 1)], DETAILS)
    once = graph.player_game_rows(d)
    plan = inspect.plan_text(once, "simple")
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and all(line.split("Sort [")[1].startswith("game_id") for line in sorts)
    assert rows(once, "game_id", "pts") == [(1, 3), (2, 4), (None, 1)]


def test_pairs_are_shuffled_with_a_flag(spark):
    d = spark.createDataFrame([(1, 1, "A", 10, "Sam", "C", 5), (1, 1, "A", 11, "Kim", "C", 3), (1, 2, None, 12, "Lee", None, 4)], DETAILS)
    e = graph.pair_edges(d)
    assert "shares_team" not in inspect.plan_text(e, "simple")         # no projection below the sums writes the label
    assert rows(e, "subject_identifier", "object_identifier", "edge_type") == [("11", "10", "shares_team"), ("12", "10", "plays_against"), ("12", "11", "plays_against")]


# ------------------------------------------------------------------ uniques that add up

def test_uniques_from_bitmaps(spark):
    ev = views.events(spark, SF_TINY)
    stored = datelist.host_user_bitmaps(ev, F.lit(True))
    users = ev.where("user_id is not null")
    assert rows(datelist.unique_users(stored, ["host", "date"]), "host", "date", "users_count") == rows(
        users.groupBy("host", F.to_date("event_time").alias("date")).agg(F.count_distinct("user_id").alias("users_count")))
    assert rows(datelist.unique_users(stored, ["host"]), "host", "users_count") == rows(users.groupBy("host").agg(F.count_distinct("user_id")))
    far = spark.createDataFrame([(i, u, 1, "h", "v", dt.datetime(2024, 1, 1 + i % 2)) for i, u in enumerate([1, -1, 0, 1, 1 << 60, 32768, 32769, -(1 << 60), 1])],
                                "event_id long, user_id long, device_id long, host string, event_type string, event_time timestamp_ntz")
    assert datelist.unique_users(datelist.host_user_bitmaps(far, F.lit(True)), ["host"]).first().users_count == 7


def test_host_counts_double_no_row(spark):
    ev = views.events(spark, SF_TINY)
    counts = datelist.host_day_counts(ev, F.lit(True))
    assert "Expand" not in inspect.plan_text(counts, "simple")
    want = ev.groupBy("host", F.to_date("event_time").alias("date")).agg(
        F.count_distinct(F.struct("event_time", "user_id", "device_id")).alias("events_count"), F.count_distinct("user_id").alias("users_count"))
    assert rows(counts) == rows(want)


# ------------------------------------------------------------------ quantile cuts from sketches

def exact_cuts(values, n):
    v = sorted(x for x in values if x is not None)
    return [next(x for i, x in enumerate(v, 1) if i * n >= len(v) * b) for b in range(1, n)] if v else []


@pytest.mark.parametrize("n", [2, 5, 10])
def test_cuts_are_exact(spark, n):
    rng = random.Random(n)
    for values in ([rng.gauss(0, 1) for _ in range(20_000)], [float(rng.randrange(5)) for _ in range(9000)], [3.0] * 50, [1.0, 2.0], [None, None], [],
                   [7.0] * 900 + [rng.random() for _ in range(100)] + [None] * 10):
        df = spark.createDataFrame([(x,) for x in values], "v double")
        assert bucketize.quantile_cuts(df, "v", n) == exact_cuts(values, n)


def test_a_cut_outside_its_bracket_is_searched_again(spark):
    df = spark.range(10_000).selectExpr("cast(id as double) as v", "cast(id % 10 as int) as day")
    wrong = bucketize.sketches(df.where("v < 500"), "v")               # sketches of other rows: brackets miss
    right = bucketize.sketches(df, "v", ["day"])
    want = exact_cuts([float(i) for i in range(10_000)], 4)
    assert bucketize.quantile_cuts(df, "v", 4, right) == want and bucketize.quantile_cuts(df, "v", 4, wrong) == want


# ------------------------------------------------------------------ a month written once a day

def test_fold_versions_writes_each_period_once(spark):
    path = shared_dir(spark, "t_versions")
    initial = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (0, "z", 9)], "month int, k string, n int")
    out = fold.fold_versions(spark, path, initial, [1, 1, 2], lambda t, p: t.where(F.col("month") == 1).selectExpr(f"{p} as month", "k", "n + 1 as n"), "month")
    assert rows(out) == rows(spark.createDataFrame([(0, "z", 9), (1, "a", 3), (1, "b", 3), (2, "a", 4), (2, "b", 4)], "month int, k string, n int"))
    written = spark.read.option("basePath", path).parquet(path)
    assert sorted((r["_run"], r["count"]) for r in written.groupBy("_run").count().collect()) == [(0, 3), (1, 2), (2, 2), (3, 2)]
