import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from dimfold.operators import contracts, dedup, facts


def test_keep_first_total_order(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 3, "z"), (2, 1, None), (2, 1, "x")],
                               "k int, o int, p string")
    assert rows(dedup.keep_first(df, ["k"], ["o"])) == [(1, 3, "z"), (2, 1, None)]
    with_rn = dedup.keep_first(df, ["k"], [F.col("o").desc()], rn_col="rn")
    assert rows(with_rn) == [(1, 5, "a", 1), (2, 1, None, 1)]


def test_dedup_dimension_all_key_columns(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "device_id long, browser_type string")
    assert rows(dedup.dedup_dimension(df)) == [(1, "a"), (1, "b")]


DETAILS = ("game_id long, team_id int, team_abbreviation string, player_id long, player_name string, "
           "start_position string, comment string, min string, fgm int, fga int, fg3m int, fg3a int, ftm int, "
           "fta int, oreb int, dreb int, reb int, ast int, stl int, blk int, `TO` int, pf int, pts int, plus_minus int")


def _detail(game, team, player, comment, mins, pts):
    return (game, team, "T", player, f"P{player}", None, comment, mins, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14,
            pts, 0)


def test_fact_details_flags_minutes_and_names(spark):
    d = spark.createDataFrame([
        _detail(1, 1, 10, "DNP - rest", "12:30", 5), _detail(1, 1, 11, "DND - flu", "12", 6),
        _detail(1, 2, 12, "NWT", "", 7), _detail(1, 2, 13, None, None, 8), _detail(1, 2, 13, None, "3:00", 9),
    ], DETAILS)
    g = spark.createDataFrame([(1, dt.date(2020, 1, 1), 2020, 1, 2)],
                              "game_id long, game_date_est date, season int, home_team_id int, visitor_team_id int")
    f = {r.dim_player_id: r for r in facts.fact_details(d, g).collect()}
    assert len(f) == 4
    assert f[10].m_minutes == 12.5 and f[10].dim_did_not_play and not f[10].dim_did_not_dress
    assert f[11].m_minutes is None and f[11].dim_did_not_dress
    assert f[12].m_minutes is None and f[12].dim_not_with_team and not f[12].dim_is_playing_at_home
    assert f[13].m_pts == 8 and not f[13].dim_did_not_play       # first by total order (NULL min first)
    assert f[10].m_ftm == 5 and f[10].m_fta == 6 and f[10].m_pf == 14   # bound by name, no shift
    rate = {r.dim_player_name: r for r in facts.fact_rate(facts.fact_details(d, g)).collect()}
    assert rate["P12"].bailed_pct == 1.0 and rate["P10"].bailed_num == 0


def test_enum_contract(spark):
    df = spark.createDataFrame([("star",), ("bad",), ("meh",), (None,)], "c string")
    assert rows(contracts.enum_violations(df, "c", ["star", "bad"])) == [("meh",)]
    prof = {r.value: (r.n_rows, r.is_allowed) for r in contracts.enum_profile(df, "c", ["star", "bad"]).collect()}
    assert prof["meh"] == (1, False) and prof[None] == (1, True)
    with pytest.raises(Exception, match="invalid value"):
        contracts.enum_enforce(df, "c", ["star", "bad"]).collect()
    assert contracts.enum_enforce(df.where("c != 'meh'"), "c", ["star", "bad"]).count() == 2


def test_key_contract(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    got = rows(contracts.key_violations(df, ["a", "b"]), "a", "b", "n_rows", "violation")
    assert got == sorted([(1, 1, 2, "duplicate"), (None, 3, 1, "null_key")], key=repr)


def test_daily_aggregate_and_denormalize(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 1)), (1, dt.datetime(2024, 1, 1, 2)),
                                (None, dt.datetime(2024, 1, 1, 3))], "user_id long, event_time timestamp_ntz")
    assert rows(facts.daily_aggregate(ev)) == [(1, dt.date(2024, 1, 1), 2)]
    fact = spark.createDataFrame([(1, 10), (2, 20)], "team_id int, pts int")
    dim = spark.createDataFrame([(1, "A")], "team_id int, name string")
    assert rows(facts.denormalize(fact, dim, "team_id", ["name"])) == [(1, 10, "A"), (2, 20, None)]
