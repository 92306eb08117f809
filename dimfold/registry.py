"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)``, reads the driver tables through the source
views and runs an operator over the whole tables.  Operators return the modeled
tables (arrays of structs, JSON bags, bitmaps); the ``report`` projections here
flatten them into plain columns (array -> text, JSON -> fields) so that an
independent SQL oracle can be compared value by value.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimfold import config as C
from dimfold.functions import arrays, classify
from dimfold.functions.props import prop
from dimfold.operators import as_of, bucketize, contracts, datelist, dedup, facts, graph, history, key_filter, reduced, scd, segments
from dimfold.plans import corrections, fold, merge, sinks
from dimfold.session import shared_dir
from dimfold.sources import views
from dimfold.streaming import dedup as stream_dedup
from dimfold.streaming import fold as stream_fold
from dimfold.streaming import hour_tree

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(key: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[key] = fn
        return fn
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _days_text(col) -> F.Column:
    return arrays.joined(col, lambda d: d.cast("string"))


# ------------------------------------------------------------------ C: de-duplication

@register("dedup_events")
def q_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = views.events(spark, sf_dir)
    return dedup.dedup_events(ev).select("event_id", "user_id", "device_id", "host", "event_type", "event_time")


@register("dedup_events_host")
def q_dedup_events_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of known devices, one per (host, time, user, device)."""
    ev = views.events(spark, sf_dir).where("user_id is not null")
    return dedup.dedup_events(ev, dedup.HOST_EVENT_KEY).select("event_id", "user_id", "device_id", "host", "event_type", "event_time")


# ------------------------------------------------------------------ F: date lists

def _fold_days(run_date: dt.date, days: int) -> list[dt.date]:
    return [run_date - dt.timedelta(days=k) for k in range(days - 1, -1, -1)]


def _folded(initial: DataFrame, run_date: dt.date, days: int, name: str, step: Callable[[DataFrame, dt.date], DataFrame]) -> DataFrame:
    """Snapshot of the run date: a partition is written each day, the next day reads that one alone."""
    spark = initial.sparkSession
    table = fold.fold(spark, shared_dir(spark, name), initial, _fold_days(run_date, days),
                      lambda t, d: step(fold.latest(t, "date", d - dt.timedelta(days=1)), d))
    return fold.latest(table, "date", run_date)


def users_cumulated_folded(spark: SparkSession, sf_dir: str, run_date: dt.date = C.RUN_DATE,
                           days: int = C.FOLD_DAYS) -> DataFrame:
    ev = views.events(spark, sf_dir)
    return _folded(datelist.dates_build(ev, run_date - dt.timedelta(days=days)), run_date, days, "users_cumulated",
                   lambda yesterday, d: datelist.dates_step(ev, yesterday, d))


@register("datelist_dates_step")
def q_datelist_dates_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = users_cumulated_folded(spark, sf_dir)
    return snap.select(
        "user_id", "date", F.size("dates_active").alias("n_dates"), _days_text(F.col("dates_active")).alias("dates")
    )


@register("datelist_bitmap")
def q_datelist_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = datelist.dates_build(views.events(spark, sf_dir), C.RUN_DATE)
    return datelist.datelist_bitmap(snap).select("user_id", "date", "datelist_int", "dim_datelist")


@register("datelist_active_flags")
def q_datelist_active_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = datelist.dates_build(views.events(spark, sf_dir), C.RUN_DATE)
    return datelist.datelist_bitmap(snap).select("user_id", "dim_is_monthly_active", "dim_is_weekly_active")


# ------------------------------------------------------------------ A: cumulative history

def _history_report(snap: DataFrame) -> DataFrame:
    h = F.col("season_stats")
    return snap.select(
        "player_name", "height", "college", "country", "draft_year", "draft_round", "draft_number",
        "current_season",
        F.size(h).alias("n_seasons"),
        arrays.joined(h, lambda x: x["season"].cast("string")).alias("seasons"),
        arrays.last(h)["pts"].alias("last_pts"),
        "scoring_class", "years_since_last_season", "is_active",
    )


@register("history_backfill")
def q_history_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    ps = views.player_seasons(spark, sf_dir)
    return _history_report(history.history_backfill(ps, C.FIRST_YEAR, C.NEXT_YEAR))


@register("cumulative_step")
def q_cumulative_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    ps = views.player_seasons(spark, sf_dir)
    yesterday = history.history_backfill(ps, C.FIRST_YEAR, C.NEXT_YEAR - 1).where(
        F.col("current_season") == C.NEXT_YEAR - 1)
    today = ps.where(F.col("season") == C.NEXT_YEAR)
    return _history_report(history.cumulative_step(today, yesterday))


def _players_at_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    ps = views.player_seasons(spark, sf_dir)
    return history.history_backfill(ps, C.FIRST_YEAR, C.NEXT_YEAR).where(F.col("current_season") == C.NEXT_YEAR)


@register("history_explode")
def q_history_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    ps = views.player_seasons(spark, sf_dir)
    return history.history_explode(history.history_backfill(ps, C.FIRST_YEAR, C.NEXT_YEAR))


@register("history_first_last")
def q_history_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = history.history_first_last(_players_at_last(spark, sf_dir))
    return out.withColumn("pts_growth", F.round("pts_growth", 4))


@register("threshold_class")
def q_threshold_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    ps = views.player_seasons(spark, sf_dir)
    return ps.select("player_name", "season", "pts", classify.scoring_class(F.col("pts")).alias("scoring_class"))


@register("static_attributes")
def q_static_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.static_attributes(views.player_seasons(spark, sf_dir))


def actors(spark: SparkSession, sf_dir: str, with_films: bool = True) -> DataFrame:
    return history.history_backfill_avg(views.actor_films(spark, sf_dir), with_films=with_films)


def actor_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actors snapshots without the film arrays: all that SCD builds read."""
    return actors(spark, sf_dir, with_films=False)


@register("history_backfill_avg")
def q_history_backfill_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = actors(spark, sf_dir)
    return a.select(
        "actor_id", "actor_name", "year",
        F.size("films").alias("n_films"),
        arrays.joined(F.col("films"), lambda f: f["film_id"]).alias("film_ids"),
        "quality_class", "is_active",
    )


# ------------------------------------------------------------------ B: SCD2

def actors_scd(spark: SparkSession, sf_dir: str, cutoff: int = C.SCD_CUTOFF) -> DataFrame:
    return scd.scd2_full(actor_classes(spark, sf_dir), cutoff)


@register("scd2_full")
def q_scd2_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actors_scd(spark, sf_dir)


def stored_scd(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """What a step finds stored: the runs so far by ``current_year`` and the snapshots by ``year``."""
    snapshots, runs = shared_dir(spark, "actors"), shared_dir(spark, "actors_scd")
    sinks.write_snapshot(actor_classes(spark, sf_dir), snapshots, ["year"])
    stored = sinks.read_snapshot(spark, snapshots)
    sinks.write_snapshot(scd.scd2_full(stored, C.SCD_CUTOFF), runs, ["current_year"])
    return sinks.read_snapshot(spark, runs), stored


@register("scd2_incremental")
def q_scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_incremental(*stored_scd(spark, sf_dir), C.SCD_CUTOFF, C.NEXT_YEAR)


def _branch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    br = scd.scd2_branches(*stored_scd(spark, sf_dir), C.SCD_CUTOFF, C.NEXT_YEAR)
    return scd.explode_branches(br.where(F.col("branch") == name))


# the players layout of the same operator
_PLAYERS_SCD = {"key": "player_name", "period": "current_season", "tracked": ("scoring_class", "is_active"), "carry": (),
                "start_col": "start_season", "end_col": "end_season", "run_col": "current_season"}


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.history_backfill(views.player_seasons(spark, sf_dir), C.FIRST_YEAR, C.NEXT_YEAR)


@register("scd2_players_full")
def q_scd2_players_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_full(players(spark, sf_dir), C.SCD_CUTOFF, **_PLAYERS_SCD)


@register("scd2_players_incremental")
def q_scd2_players_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored run and the stored snapshot of the new season meet in one join."""
    p = players(spark, sf_dir).select("player_name", "scoring_class", "is_active", "current_season")
    run = sinks.materialize(spark, scd.scd2_full(p, C.SCD_CUTOFF, **_PLAYERS_SCD), "players_scd")
    return scd.scd2_incremental(run, p, C.SCD_CUTOFF, C.NEXT_YEAR, **_PLAYERS_SCD)


@register("scd2_unchanged")
def q_scd2_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _branch(spark, sf_dir, "unchanged")


@register("scd2_changed")
def q_scd2_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _branch(spark, sf_dir, "changed")


@register("scd2_new")
def q_scd2_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _branch(spark, sf_dir, "new")


@register("scd2_closed")
def q_scd2_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_closed(actors_scd(spark, sf_dir), C.SCD_CUTOFF)


@register("scd_type0")
def q_scd_type0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd_type0(actor_classes(spark, sf_dir), "actor_id", "year", ["quality_class"])


@register("scd_type1")
def q_scd_type1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd_type1(actor_classes(spark, sf_dir), "actor_id", "year", ["quality_class"])


@register("scd_type3")
def q_scd_type3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd_type3(actor_classes(spark, sf_dir), "actor_id", "year", ["quality_class"])


@register("scd2_point_in_time")
def q_scd2_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions valid in one period, of the run that ends after it."""
    return scd.scd2_as_of(actors_scd(spark, sf_dir, C.NEXT_YEAR), C.SCD_CUTOFF - 1).select("actor_id", "quality_class", "is_active")


@register("scd2_as_of")
def q_scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2_expand(actors_scd(spark, sf_dir))


# ------------------------------------------------------------------ C / D / T5 / T7: facts

@register("dedup_details")
def q_dedup_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_details(views.game_details(spark, sf_dir), views.games(spark, sf_dir))


@register("dedup_dimension")
def q_dedup_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_dimension(views.devices(spark, sf_dir))


def fct_game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_details(views.game_details(spark, sf_dir), views.games(spark, sf_dir))


@register("fact_details")
def q_fact_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fct_game_details(spark, sf_dir).withColumn("m_minutes", F.round("m_minutes", 4))


@register("fact_rate")
def q_fact_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_rate(fct_game_details(spark, sf_dir))


@register("denormalize_fact")
def q_denormalize_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    gd = views.game_details(spark, sf_dir).select("game_id", "player_id", "team_id", "pts")
    teams = dedup.dedup_dimension(views.teams(spark, sf_dir), ["team_id"])
    return facts.denormalize(gd, teams, "team_id", ["abbreviation", "nickname", "city", "arena"])


@register("daily_aggregate")
def q_daily_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.daily_aggregate(views.events(spark, sf_dir))


# ------------------------------------------------------------------ K: contracts

@register("enum_contract")
def q_enum_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.enum_profile(actor_classes(spark, sf_dir), "quality_class", classify.QUALITY_LABELS)


@register("enum_violations")
def q_enum_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots whose class is outside a narrower set: the last label is left out."""
    a = actor_classes(spark, sf_dir).select("actor_id", "year", "quality_class")
    return contracts.enum_violations(a, "quality_class", classify.QUALITY_LABELS[:-1])


@register("enum_enforced")
def q_enum_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = actor_classes(spark, sf_dir).select("actor_id", "year", "quality_class")
    return contracts.enum_enforce(a, "quality_class", classify.QUALITY_LABELS)


@register("key_contract_built")
def q_key_contract_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve declared keys of built tables: rows, distinct keys and keys that break the contract."""
    a = sinks.materialize(spark, actor_classes(spark, sf_dir), "actors")                # built once, read for two of the keys
    p = sinks.materialize(spark, players(spark, sf_dir).select("player_name", "scoring_class", "is_active", "current_season"), "players")
    ev, moved = views.events(spark, sf_dir), _shifted(spark, sf_dir)
    first_day = moved.select(F.min(F.to_date("event_time"))).first()[0] or C.MONTH_RUN_DATE
    hosts = datelist.host_build(moved, first_day).unionByName(datelist.host_build(moved, C.MONTH_RUN_DATE))
    v, e = graph_tables(spark, sf_dir)
    built = [
        ("actors", a, ["actor_id", "year"]),
        ("users_devices_cumulated", datelist.device_build(ev, views.devices(spark, sf_dir), C.RUN_DATE), ["user_id", "device_id", "date"]),
        ("hosts_cumulated", datelist.host_build(ev, C.RUN_DATE), ["host", "date"]),
        ("host_activity_reduced", reduced.host_batch(hosts, from_first_seen=True), ["month", "host"]),
        ("players_scd", scd.scd2_full(p, C.SCD_CUTOFF, **_PLAYERS_SCD), ["player_name", "start_season"]),
        ("vertices", v, ["identifier", "type"]),
        ("edges", e, _EDGE_KEY),
        ("array_metrics", reduced.metric_build(moved, C.MONTH_RUN_DATE), _METRIC_KEY),
        ("actors_scd", scd.scd2_full(a, C.SCD_CUTOFF), ["actor_id", "start_year"]),
        ("fct_game_details", fct_game_details(spark, sf_dir), ["dim_game_date", "dim_team_id", "dim_player_id"]),
        ("players", p, ["player_name", "current_season"]),
        ("users_cumulated", datelist.dates_build(views.events(spark, sf_dir), C.RUN_DATE), ["user_id", "date"]),
    ]
    return reduce(DataFrame.unionByName, [contracts.key_summary(df, keys, name) for name, df, keys in built])


def _event_slices(spark: SparkSession, sf_dir: str) -> tuple[list[tuple[str, DataFrame]], int]:
    """The events in slices of LANDING_SLICE_DAYS days, each a pruned read, and the number of all events."""
    span = views.events(spark, sf_dir).agg(F.min(F.to_date("event_time")).alias("lo"), F.max(F.to_date("event_time")).alias("hi"),
                                           F.count(F.lit(1)).alias("n")).first()
    out = []
    while span.lo is not None and (day := span.lo + dt.timedelta(days=len(out) * C.LANDING_SLICE_DAYS)) <= span.hi:
        out.append((f"slice-{len(out)}", views.events(spark, sf_dir, first=day, last=day + dt.timedelta(days=C.LANDING_SLICE_DAYS - 1))))
    return out, span.n


_VISIT_KEY = ["user_id", "device_id", "event_type"]


@register("key_contract_partitions")
def q_key_contract_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key over a table that grows slice by slice: each new slice is compared with itself and, through stored
    filters, with all slices before it; counts of violations by the slice that holds the key already."""
    slices, n_events = _event_slices(spark, sf_dir)
    guard = key_filter.KeyGuard(spark, shared_dir(spark, "key_guard"), _VISIT_KEY, expected_keys=n_events)
    found = [guard.add(rows.select(*_VISIT_KEY), name).withColumn("checked", F.lit(name)) for name, rows in slices]
    if not found:
        return spark.createDataFrame([], "checked string, violation string, held_by string, n_keys long")
    return (reduce(DataFrame.unionByName, found).groupBy("checked", "violation", F.col(guard.part).alias("held_by"))
            .agg(F.count(F.lit(1)).alias("n_keys")))


@register("key_contract")
def q_key_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.key_violations(views.game_details(spark, sf_dir), list(dedup.DETAIL_KEY))


# ------------------------------------------------------------------ E: graph

def _player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box scores that the graph is built from, de-duplicated once and stored."""
    return sinks.materialize(spark, graph.player_game_rows(views.game_details(spark, sf_dir)), "player_games")


def graph_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All vertices and all edges, built from box scores de-duplicated once."""
    rows = _player_games(spark, sf_dir)
    return vertices(spark, sf_dir, rows), graph.plays_in_edges(rows, deduplicate=False).unionByName(graph.pair_edges(rows, deduplicate=False))


def vertices(spark: SparkSession, sf_dir: str, player_games: DataFrame | None = None) -> DataFrame:
    players_of = (graph.player_vertices(views.game_details(spark, sf_dir)) if player_games is None
                  else graph.player_vertices(player_games, deduplicate=False))
    return (graph.game_vertices(views.games(spark, sf_dir)).unionByName(players_of)
            .unionByName(graph.team_vertices(views.teams(spark, sf_dir))))


def stored_graph(spark: SparkSession, sf_dir: str, edges: Callable[..., DataFrame], keys: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The partitions of the graph tables that a read needs, as consumers find them: player vertices and one kind of
    edges, stored with the properties that are read as typed columns.  Both come from box scores de-duplicated once."""
    rows = _player_games(spark, sf_dir)
    v = graph.typed_properties(graph.player_vertices(rows, deduplicate=False), graph.PLAYER_PROPERTIES)
    e = graph.typed_properties(edges(rows, deduplicate=False), keys)
    v_path, e_path = shared_dir(spark, "vertices"), shared_dir(spark, "edges")
    sinks.write_snapshot(v, v_path, ["type"])
    sinks.write_snapshot(e, e_path, ["edge_type"])
    return sinks.read_snapshot(spark, v_path), sinks.read_snapshot(spark, e_path)


def _fields(df: DataFrame, keep: list[str], keys: list[str]) -> DataFrame:
    """Columns and fields of the JSON bag as text, the bag parsed once a row."""
    return df.select(*keep, F.json_tuple("properties", *keys).alias(*keys))


@register("graph_vertices_fact")
def q_graph_vertices_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = graph.game_vertices(views.games(spark, sf_dir))
    return _fields(v, ["identifier", "type"], ["pts_home", "pts_away", "winning_team"])


@register("graph_vertices_agg")
def q_graph_vertices_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = graph.player_vertices(views.game_details(spark, sf_dir))
    return _fields(v, ["identifier", "type"], ["player_name", "number_of_games", "total_points", "teams"])


@register("graph_vertices_dim")
def q_graph_vertices_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = graph.team_vertices(views.teams(spark, sf_dir))
    return _fields(v, ["identifier", "type"], ["abbreviation", "nickname", "city", "arena", "year_founded"])


_EDGE_KEY = ["subject_identifier", "subject_type", "object_identifier", "object_type", "edge_type"]


@register("graph_edges_bipartite")
def q_graph_edges_bipartite(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = graph.plays_in_edges(views.game_details(spark, sf_dir))
    return _fields(e, _EDGE_KEY, ["start_position", "pts", "team_id", "team_abbreviation"])


@register("graph_edges_pairwise")
def q_graph_edges_pairwise(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the pairs read the box scores several times: they are de-duplicated once
    e = graph.pair_edges(_player_games(spark, sf_dir), deduplicate=False)
    return _fields(e, _EDGE_KEY, ["num_games", "subject_points", "object_points"])


@register("graph_max_property")
def q_graph_max_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = stored_graph(spark, sf_dir, graph.plays_in_edges, graph.PLAYS_IN_PROPERTIES)
    # the property stands on the edges of one type: only their partition is read
    return graph.max_typed_property(v.where("type = 'player'"), e.where("edge_type = 'plays_in'"))


@register("graph_pair_vs_career")
def q_graph_pair_vs_career(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, e = stored_graph(spark, sf_dir, graph.pair_edges, graph.PAIR_PROPERTIES)
    return graph.typed_pair_vs_career(v.where("type = 'player'"), e.where("edge_type in ('shares_team', 'plays_against')"))


@register("map_properties")
def q_map_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = graph.property_map(vertices(spark, sf_dir))
    return m.select("identifier", "type", F.explode("properties").alias("key", "value"))


# ------------------------------------------------------------------ F2 / F3 / H2: daily folds

@register("datelist_device_step")
def q_datelist_device_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = views.events(spark, sf_dir)
    dev = sinks.materialize(spark, dedup.dedup_dimension(views.devices(spark, sf_dir)), "devices")     # one pass for all days
    snap = _folded(datelist.device_build(ev, dev, C.RUN_DATE - dt.timedelta(days=C.FOLD_DAYS), deduplicated=True), C.RUN_DATE, C.FOLD_DAYS,
                   "users_devices_cumulated", lambda yesterday, d: datelist.device_step(ev, dev, yesterday, d, deduplicated=True))
    lst = F.col("device_activity_datelist")
    return snap.select(
        "user_id", "device_id", "date", F.size(lst).alias("n_entries"),
        arrays.joined(lst, lambda x: F.concat_ws(":", x["date"].cast("string"), x["browser_type"],
                                                 x["events_count"].cast("string"))).alias("entries"),
    )


@register("datelist_device_bitmap")
def q_datelist_device_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bitmap per user and device; a day with several browsers sets its bit once."""
    snap = datelist.device_build(views.events(spark, sf_dir), views.devices(spark, sf_dir), C.RUN_DATE)
    days = F.array_distinct(F.transform("device_activity_datelist", lambda e: e["date"]))
    return datelist.datelist_bitmap(snap, dates=days).select("user_id", "device_id", "date", "datelist_int", "dim_datelist")


def hosts_cumulated_folded(ev: DataFrame, run_date: dt.date = C.RUN_DATE, days: int = C.FOLD_DAYS) -> DataFrame:
    return _folded(datelist.host_build(ev, run_date - dt.timedelta(days=days)), run_date, days, "hosts_cumulated",
                   lambda yesterday, d: datelist.host_step(ev, yesterday, d))


def _host_entries(col) -> F.Column:
    return arrays.joined(col, lambda x: F.concat_ws(":", x["date"].cast("string"), x["events_count"].cast("string"),
                                                    x["users_count"].cast("string")))


@register("datelist_host_step")
def q_datelist_host_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = hosts_cumulated_folded(views.events(spark, sf_dir))
    lst = F.col("host_activity_datelist")
    return snap.select("host", "date", F.size(lst).alias("n_entries"), _host_entries(lst).alias("entries"))


@register("snapshot_write")
def q_snapshot_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day N is written to its own partition; day N+1 reads day N's files; re-running N+1 replaces it."""
    ev = views.events(spark, sf_dir)
    path = shared_dir(spark, "users_cumulated")
    prev = C.RUN_DATE - dt.timedelta(days=1)
    sinks.write_snapshot(datelist.dates_build(ev, prev), path, ["date"])
    for _ in range(2):
        yesterday = sinks.read_snapshot(spark, path, F.col("date") == F.lit(prev))
        sinks.write_snapshot(datelist.dates_step(ev, yesterday, C.RUN_DATE), path, ["date"])
    snap = sinks.read_snapshot(spark, path)
    return snap.select(
        "user_id", "date", F.size("dates_active").alias("n_dates"), _days_text(F.col("dates_active")).alias("dates"))


# ------------------------------------------------------------------ G / H1: reduced facts

def _shifted(spark: SparkSession, sf_dir: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Events on the moved clock; a day range reaches the scan."""
    return views.events(spark, sf_dir, shift_days=C.MONTH_SHIFT_DAYS, first=first, last=last)


_METRIC_KEY = ["user_id", "month_start", "metric_name"]


def _ints_text(col) -> F.Column:
    return arrays.joined(col, lambda x: x.cast("long").cast("string"))


def _metric_report(t: DataFrame) -> DataFrame:
    return t.select("user_id", "month_start", "metric_name", F.size("metric_array").alias("n_days"),
                    _ints_text(F.col("metric_array")).alias("metric_values"))


def array_metrics_folded(spark: SparkSession, sf_dir: str, run_date: dt.date = C.MONTH_RUN_DATE,
                         days: int = C.FOLD_DAYS) -> DataFrame:
    """Month arrays built in batch up to ``run_date - days``, then one daily step per day.

    Each step reads the events of its day alone and writes the month once, under its
    own run; the next step reads those files, so the plan stays one step deep however
    many days run.
    """
    start = run_date - dt.timedelta(days=days)
    initial = reduced.metric_build(_shifted(spark, sf_dir, last=start), start)
    return fold.fold_versions(spark, shared_dir(spark, "array_metrics"), initial, _fold_days(run_date, days),
                              lambda table, d: reduced.metric_step(_shifted(spark, sf_dir, d, d), table, d), "month_start")


@register("reduced_metric_step")
def q_reduced_metric_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_report(array_metrics_folded(spark, sf_dir))


@register("upsert_by_key")
def q_upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = C.MONTH_RUN_DATE - dt.timedelta(days=1)
    existing = sinks.materialize(spark, reduced.metric_build(_shifted(spark, sf_dir, last=before), before), "array_metrics")
    incoming = reduced.metric_step(_shifted(spark, sf_dir, C.MONTH_RUN_DATE, C.MONTH_RUN_DATE), existing, C.MONTH_RUN_DATE)
    return _metric_report(sinks.upsert(existing, incoming, _METRIC_KEY))


def _host_report(t: DataFrame) -> DataFrame:
    return t.select("month", "host", F.size("hit_array").alias("n_days"),
                    _ints_text(F.col("hit_array")).alias("hits"),
                    _ints_text(F.col("unique_visitors_array")).alias("unique_visitors"))


@register("reduced_host_step")
def q_reduced_host_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = C.MONTH_RUN_DATE - dt.timedelta(days=C.FOLD_DAYS)
    initial = reduced.host_batch(datelist.host_build(_shifted(spark, sf_dir, last=start), start), from_first_seen=True)
    table = fold.fold_versions(spark, shared_dir(spark, "host_activity_reduced"), initial, _fold_days(C.MONTH_RUN_DATE, C.FOLD_DAYS),
                               lambda t, d: reduced.host_step(_shifted(spark, sf_dir, d, d), t, d), "month")
    return _host_report(table)


@register("reduced_host_batch")
def q_reduced_host_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _shifted(spark, sf_dir)
    first_day = ev.select(F.min(F.to_date("event_time"))).scalar()
    # hosts_cumulated is a stored table (one partition per snapshot date): its first and its latest snapshot
    path = shared_dir(spark, "hosts_cumulated")
    sinks.write_snapshot(datelist.host_build(ev, first_day), path, ["date"])
    sinks.write_snapshot(datelist.host_build(ev, C.MONTH_RUN_DATE), path, ["date"])
    return _host_report(reduced.host_batch(sinks.read_snapshot(spark, path)))


@register("reduced_expand")
def q_reduced_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduced.expand(array_metrics_folded(spark, sf_dir))


# ------------------------------------------------------------------ T1 / T2 / T6

@register("dedup_stream")
def q_dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events (with their re-delivered copies) landed in time order, de-duplicated by a streaming query.

    The landing folder receives one time slice after the other; within a slice rows have no order, so the
    watermark's delay is a slice and a day.  A trigger reads about a slice of files.
    """
    ev = views.events(spark, sf_dir)
    landing = shared_dir(spark, "events_landing")
    span = ev.agg(F.min(F.to_date("event_time")).alias("lo"), F.max(F.to_date("event_time")).alias("hi")).first()
    slices = 0
    while span.lo is not None and (day := span.lo + dt.timedelta(days=slices * C.LANDING_SLICE_DAYS)) <= span.hi:
        views.events(spark, sf_dir, first=day, last=day + dt.timedelta(days=C.LANDING_SLICE_DAYS - 1)).write.mode("append").parquet(landing)
        slices += 1
    if not slices:
        ev.write.parquet(landing)
    files = len(spark.read.schema(ev.schema).parquet(landing).inputFiles())
    out = stream_dedup.run_dedup(
        spark, landing, ev.schema, dedup.EVENT_KEY, "event_time", f"{C.LANDING_SLICE_DAYS + 1} days",
        out_path=shared_dir(spark, "events_dedup"), checkpoint=shared_dir(spark, "events_dedup_ckpt"),
        max_files_per_trigger=max(1, files // max(1, slices)))
    return out.select("event_id", "user_id", "device_id", "host", "event_type", "event_time")


@register("dedup_hourly")
def q_dedup_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which copy of an event is kept is open in this form, so the query returns the keys."""
    return stream_dedup.dedup_hourly_batch(views.events(spark, sf_dir), dedup.EVENT_KEY, "event_time").select(*dedup.EVENT_KEY)


@register("fold_on_arrival")
def q_fold_on_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily folds driven by landed files, a file a trigger; the last day is not complete until a later one arrives."""
    ev = views.events(spark, sf_dir)
    start = C.RUN_DATE - dt.timedelta(days=C.FOLD_DAYS + 1)
    landing, path = shared_dir(spark, "fold_landing"), shared_dir(spark, "users_cumulated")
    ev.write.parquet(landing)
    sinks.write_snapshot(datelist.dates_build(ev, start), path, ["date"])

    def step(events: DataFrame, table: DataFrame, day: dt.date) -> DataFrame:
        return datelist.dates_step(events, table.where(F.col("date") == F.lit(day - dt.timedelta(days=1))), day)

    snap = stream_fold.fold_on_arrival(spark, landing, ev.schema, path, step, shared_dir(spark, "fold_ckpt"), max_files_per_trigger=1)
    return snap.select("user_id", "date", F.size("dates_active").alias("n_dates"), _days_text(F.col("dates_active")).alias("dates"))


@register("bucketize")
def q_bucketize(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = views.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    return bucketize.bucketize(o, "o_totalprice", n_buckets=5, out="price_bucket")


@register("bucketize_stored")
def q_bucketize_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same buckets from sketches that every order year has left in a stored table."""
    o = views.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    kept = sinks.materialize(spark, bucketize.sketches(o, "o_totalprice", [F.year("o_orderdate").alias("year")]), "price_sketches")
    return bucketize.bucketize(o.select("o_orderkey", "o_totalprice"), "o_totalprice", n_buckets=5, out="price_bucket", stored=kept)


@register("bucketed_fact")
def q_bucketed_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box scores bucketed by player once; the per-player aggregate then needs no exchange."""
    gd = views.game_details(spark, sf_dir)
    path = shared_dir(spark, "gd_bucketed")
    table = "gd_bucketed_" + path.rsplit("/", 1)[-1]
    sinks.write_bucketed(gd, table, int(spark.conf.get("spark.sql.shuffle.partitions")), ["player_id"], path)
    return spark.table(table).groupBy("player_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("pts").alias("total_pts"))


@register("scd2_join_as_of")
def q_scd2_join_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each film credit with the actor's SCD2 version valid in the film's year."""
    films = views.actor_films(spark, sf_dir).select(F.col("actorid").alias("actor_id"), "filmid", "year")
    return scd.scd2_join_as_of(films, actors_scd(spark, sf_dir, C.NEXT_YEAR))


@register("scd2_merge_as_of")
def q_scd2_merge_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by merging versions and credits in one sorted stream: linear in both, however many versions an actor has."""
    films = views.actor_films(spark, sf_dir).select(F.col("actorid").alias("actor_id"), "filmid", "year")
    return as_of.merge_as_of(films, actors_scd(spark, sf_dir, C.NEXT_YEAR), "actor_id", "year", "start_year", "end_year", ["quality_class", "is_active"])


# ------------------------------------------------------------------ late data, merges, segments, uniques that add up

def _landed_late(spark: SparkSession, sf_dir: str, landing: str) -> DataFrame:
    """Land the events in two deliveries, those of LATE_MINUTES after all others; returns the feed."""
    ev = views.events(spark, sf_dir)
    late = F.minute("event_time").between(*C.LATE_MINUTES)
    ev.where(~late).write.mode("append").parquet(landing)
    ev.where(late).write.mode("append").parquet(landing)
    return ev


@register("dedup_hour_tree")
def q_dedup_hour_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First visit of a user's device by day and type, and how many there were, from the roots of the hours' merge trees;
    late events of the run date have re-merged the paths of their hours."""
    landing, path = shared_dir(spark, "tree_landing"), shared_dir(spark, "hour_tree")
    ev = views.events(spark, sf_dir)
    late = F.minute("event_time").between(*C.LATE_MINUTES) & (F.to_date("event_time") == F.lit(C.RUN_DATE))
    for part in (~late, late):                                    # two deliveries, an update each
        rows = ev.where(part)
        rows.write.mode("append").parquet(landing)
        hour_tree.update(spark, path, spark.read.schema(ev.schema).parquet(landing), hour_tree._hours(rows, "event_time"), _VISIT_KEY)
    return hour_tree.day_rows(spark, path).select("day", *_VISIT_KEY, "event_id", "event_time", hour_tree.COPIES)


@register("fold_corrected")
def q_fold_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily folds driven by landed files whose late events correct the snapshots folded before, for their users alone."""
    landing, path, log = shared_dir(spark, "late_landing"), shared_dir(spark, "users_cumulated"), shared_dir(spark, "late_log")
    ev = _landed_late(spark, sf_dir, landing)
    start = C.RUN_DATE - dt.timedelta(days=C.FOLD_DAYS + 1)
    on_time = ev.where(~F.minute("event_time").between(*C.LATE_MINUTES))
    corrections.write_day(datelist.dates_build(on_time, start), path)
    files = len(spark.read.schema(ev.schema).parquet(landing).inputFiles())
    snap = stream_fold.fold_with_corrections(spark, landing, ev.schema, path, log, datelist.dates_step, datelist.dates_build,
                                             {"user_id": "user_id"}, shared_dir(spark, "late_ckpt"), max_files_per_trigger=max(1, files // 2))
    return snap.select("user_id", "date", F.size("dates_active").alias("n_dates"), _days_text(F.col("dates_active")).alias("dates"))


@register("merge_by_key")
def q_merge_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run date's month arrays merged into a stored table, of which only the touched buckets are rewritten."""
    before = C.MONTH_RUN_DATE - dt.timedelta(days=1)
    path = shared_dir(spark, "array_metrics_merge")
    merge.create(reduced.metric_build(_shifted(spark, sf_dir, last=before), before), path, _METRIC_KEY, buckets=16)
    today = _shifted(spark, sf_dir, C.MONTH_RUN_DATE, C.MONTH_RUN_DATE)
    incoming = reduced.metric_step(today, merge.read(spark, path), C.MONTH_RUN_DATE)
    merge.merge(sinks.materialize(spark, incoming, "incoming"), path)
    return _metric_report(merge.read(spark, path))


_SEASON_ITEM = ["gp", "pts", "reb", "ast"]


def season_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ps = views.player_seasons(spark, sf_dir).where(F.col("season").between(C.FIRST_YEAR, C.NEXT_YEAR))
    return segments.build(ps, "player_name", ["season"], _SEASON_ITEM, C.SEGMENT_ITEMS)


@register("history_segments")
def q_history_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Film credits of every actor in numbered segments of bounded length, last years appended to the open segments."""
    films = views.actor_films(spark, sf_dir).withColumnRenamed("actorid", "actor_id")
    order, items = ["year", "filmid"], ["film", "votes", "rating"]
    stored = sinks.materialize(spark, segments.build(films.where(F.col("year") <= C.SCD_CUTOFF), "actor_id", order, items, C.SEGMENT_ITEMS), "segments")
    later = segments.append(stored, films.where(F.col("year") > C.SCD_CUTOFF), "actor_id", order, items, C.SEGMENT_ITEMS)
    return sinks.upsert(stored, later, ["actor_id", "segment"]).select(
        "actor_id", "segment", "n_items", F.col("first").alias("first_year"), F.col("last").alias("last_year"),
        arrays.joined(F.col("items"), lambda x: x["filmid"]).alias("film_ids"))


@register("segments_explode")
def q_segments_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 over segments: the seasons of every player's snapshot of each year."""
    flat = segments.explode(season_segments(spark, sf_dir), "player_name")
    years = F.explode(F.sequence(F.col("season"), F.lit(C.NEXT_YEAR))).alias("current_season")
    return flat.select("player_name", years, "season", *_SEASON_ITEM)


@register("segments_first_last")
def q_segments_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segments.first_last(season_segments(spark, sf_dir), "player_name", "pts")
    return out.select("player_name", F.col("first_value").alias("first_season_pts"), F.col("last_value").alias("last_season_pts"),
                      F.col("n_items").cast("int").alias("number_of_active_seasons"), F.round("growth", 4).alias("pts_growth"))


def stored_user_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.materialize(spark, datelist.host_user_bitmaps(views.events(spark, sf_dir), F.lit(True)), "host_user_bitmaps")


@register("host_uniques_daily")
def q_host_uniques_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datelist.unique_users(stored_user_bitmaps(spark, sf_dir), ["host", "date"])


@register("host_uniques_monthly")
def q_host_uniques_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of a month from the stored days, and of all hosts together."""
    stored = stored_user_bitmaps(spark, sf_dir)
    month = F.trunc("date", "MM").alias("month")
    per_host = datelist.unique_users(stored, ["host", month])
    return per_host.unionByName(datelist.unique_users(stored, [month]).withColumn("host", F.lit("all hosts")))
