"""Fact tables (operators D1, D2, T5, T7).

``fact_details`` keeps one detail row per (game, team, player) (``WindowGroupLimit``
trims duplicates map-side), binds the output by name (the positional insert in
the scripts shifts columns), and parses ``mm:ss`` with ``try_cast`` so a bad
value is NULL instead of an ANSI error.  ``denormalize`` leaves the join
strategy to Catalyst/AQE: a dimension is broadcast only when its measured size
is under ``spark.sql.autoBroadcastJoinThreshold``, otherwise it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.operators.dedup import DETAIL_KEY, keep_first

# fixed values: box-score columns renamed to fact measures (source -> measure)
MEASURES = (
    ("fgm", "m_fgm"), ("fga", "m_fga"), ("fg3m", "m_fg3m"), ("fg3a", "m_fg3a"), ("ftm", "m_ftm"),
    ("fta", "m_fta"), ("oreb", "m_oreb"), ("dreb", "m_dreb"), ("reb", "m_reb"), ("ast", "m_ast"),
    ("stl", "m_stl"), ("blk", "m_blk"), ("TO", "m_turnovers"), ("pf", "m_pf"), ("pts", "m_pts"),
    ("plus_minus", "m_plus_minus"),
)


def minutes(mmss: Column) -> Column:
    """``'mm:ss'`` -> decimal minutes; NULL when either part is missing or not a number."""
    mm = F.split_part(mmss, F.lit(":"), F.lit(1)).try_cast("double")
    ss = F.split_part(mmss, F.lit(":"), F.lit(2)).try_cast("double")
    return mm + ss / 60


def _flag(comment: Column, code: str) -> Column:
    return F.coalesce(comment.contains(code), F.lit(False))


def fact_details(details: DataFrame, games: DataFrame) -> DataFrame:
    """``fct_game_details`` from box scores and the game header."""
    g = games.select("game_id", "game_date_est", "season", "home_team_id", "visitor_team_id")
    deduped = keep_first(details.join(g, "game_id"), list(DETAIL_KEY), order=["game_date_est"])
    c = F.col("comment")
    return deduped.select(
        F.col("game_date_est").alias("dim_game_date"),
        F.col("season").alias("dim_season"),
        F.col("team_id").alias("dim_team_id"),
        F.col("player_id").alias("dim_player_id"),
        F.col("player_name").alias("dim_player_name"),
        F.col("start_position").alias("dim_start_position"),
        (F.col("team_id") == F.col("home_team_id")).alias("dim_is_playing_at_home"),
        _flag(c, "DNP").alias("dim_did_not_play"),
        _flag(c, "DND").alias("dim_did_not_dress"),
        _flag(c, "NWT").alias("dim_not_with_team"),
        minutes(F.col("min")).alias("m_minutes"),
        *[F.col(f"`{src}`").alias(dst) for src, dst in MEASURES],
    )


def fact_rate(fact: DataFrame, entity: str = "dim_player_name", flag: str = "dim_not_with_team",
              ordered: bool = True) -> DataFrame:
    """Games per entity, games with the flag set, and their ratio (highest ratio first)."""
    agg = fact.groupBy(entity).agg(
        F.count(F.lit(1)).alias("num_games"),
        F.count(F.when(F.col(flag), 1)).alias("bailed_num"),
    ).withColumn("bailed_pct", F.col("bailed_num").cast("double") / F.col("num_games"))
    return agg.orderBy(F.col("bailed_pct").desc_nulls_first()) if ordered else agg


def denormalize(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], attrs: Sequence[str],
                how: str = "left") -> DataFrame:
    """T5: bring dimension attributes onto the fact (dimension must be unique on ``key``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return fact.join(dim.select(*keys, *attrs), keys, how)


def daily_aggregate(events: DataFrame, entity: str = "user_id", ts: str = "event_time",
                    metric: str = "num_site_hits") -> DataFrame:
    """Event grain -> daily grain (one row per entity and day)."""
    return (
        events.where(F.col(entity).isNotNull())
        .groupBy(entity, F.to_date(ts).alias("date"))
        .agg(F.count(F.lit(1)).alias(metric))
    )
