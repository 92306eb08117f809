"""Keyed de-duplication (operators C1, C2, C3).

``keep_first`` is ``row_number() over (partition by key order by ...) = 1``.
Spark plans it as a ``WindowGroupLimit`` that already keeps one row per key
inside every map task before the shuffle, so a key that holds a large share of
the rows is cut down before it is moved.  The reference leaves the order open;
here the order is always total (explicit order columns, then every remaining
column), so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> list[Column]:
    """``order`` followed by every other non-key column ascending, NULLs first."""
    cols: list[Column] = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    named = {c for c in order if isinstance(c, str)}
    for name, dtype in df.dtypes:
        if name in keys or name in named or dtype.startswith(("map", "array", "struct")):
            continue
        cols.append(F.col(name).asc_nulls_first())
    return cols


def keep_first(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column | str] = (),
    rn_col: str | None = None,
) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (made total). Optionally keep ``rn``."""
    key_names = [k for k in keys if isinstance(k, str)]
    # when every column is a key the rows of a partition are identical: any order is total
    ordering = total_order(df, key_names, order) or [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    rn = rn_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1)
    return out if rn_col else out.drop(rn)


# fixed values: de-duplication keys of the modeled feeds
DETAIL_KEY = ("game_id", "team_id", "player_id")
EVENT_KEY = ("user_id", "device_id", "event_time")
HOST_EVENT_KEY = ("host", "event_time", "user_id", "device_id")
DEVICE_KEY = ("device_id", "browser_type")


def dedup_details(details: DataFrame, games: DataFrame) -> DataFrame:
    """One detail row per (game, team, player, game date), with ``rn``."""
    g = games.select("game_id", "game_date_est")
    joined = details.join(g, "game_id")
    out = keep_first(joined, [*DETAIL_KEY, "game_date_est"], rn_col="rn")
    return out.select(*details.columns, "rn")


def dedup_events(events: DataFrame, key: Sequence[str] = EVENT_KEY) -> DataFrame:
    """One event per key; the lowest ``event_id`` (then payload) wins."""
    order = ["event_id"] if "event_id" in events.columns else []
    return keep_first(events, list(key), order)


def dedup_dimension(dim: DataFrame, key: Sequence[str] = DEVICE_KEY) -> DataFrame:
    """One row per dimension key."""
    return keep_first(dim, list(key))
