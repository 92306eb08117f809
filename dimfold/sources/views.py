"""Source views: the reference's raw feeds, derived from the driver tables.

The modeling operators consume feeds shaped like ``actor_films``,
``player_seasons``, ``games``, ``game_details``, ``teams``, ``events`` and
``devices``.  The driver ships TPC-H-like tables instead, so each view below is a
plain projection / aggregation of those tables.  All derivations are row-level
rules over whole tables (no sampling, no id subsets); numeric values that feed
thresholds are built on exact binary fractions (quarters) so that every engine
classifies them identically.

The same derivations are written in DuckDB SQL in ``dimfold.oracle`` for the
correctness check.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimfold.sources.tables import read_table


def _int(c: Column) -> Column:
    return c.cast("int")


def actor_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as film credits: actor = customer, film = order, year = order year."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return o.select(
        F.col("o_custkey").cast("string").alias("actorid"),
        F.concat(F.lit("Actor "), F.col("o_custkey").cast("string")).alias("actor"),
        F.col("o_orderpriority").alias("film"),
        _int(F.floor(F.col("o_totalprice") / 1000)).alias("votes"),
        (F.lit(4.0) + F.floor(F.col("o_totalprice") / 25000) / 4).alias("rating"),
        F.col("o_orderkey").cast("string").alias("filmid"),
        F.year("o_orderdate").alias("year"),
    )


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders aggregated to one row per (customer, year) as a player's season."""
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    seasons = o.groupBy(F.col("o_custkey"), F.year("o_orderdate").alias("season")).agg(
        _int(F.count(F.lit(1))).alias("gp"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"),
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).cast("double").alias("reb"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).cast("double").alias("ast"),
    )
    return (
        seasons.join(c, seasons.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .select(
            F.col("c_name").alias("player_name"),
            F.concat(F.lit("6-"), F.col("c_nationkey").cast("string")).alias("height"),
            F.col("c_mktsegment").alias("college"),
            F.col("n_name").alias("country"),
            (F.lit(1990) + F.col("n_regionkey")).cast("string").alias("draft_year"),
            (F.col("n_regionkey") + 1).cast("string").alias("draft_round"),
            (F.col("c_nationkey") + 1).cast("string").alias("draft_number"),
            F.col("season"),
            F.col("gp"),
            (F.floor(F.col("cents") / (F.col("gp") * 500000.0)) / 4).alias("pts"),
            F.col("reb"),
            F.col("ast"),
        )
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as games: home team = customer's nation."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    g = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("game_id"),
        F.to_date("o_orderdate").alias("game_date_est"),
        F.year("o_orderdate").alias("season"),
        F.col("c_nationkey").alias("home_team_id"),
        _int(F.pmod(F.col("c_nationkey") + 7, F.lit(25))).alias("visitor_team_id"),
        _int(F.lit(80) + F.floor(F.col("o_totalprice") / 10000)).alias("pts_home"),
        _int(F.lit(80) + F.pmod(F.col("o_orderkey"), F.lit(50))).alias("pts_away"),
    )
    return g.withColumn("home_team_wins", F.when(F.col("pts_home") > F.col("pts_away"), 1).otherwise(0))


def game_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x supplier as box scores: game = order, player = supplier, team = supplier nation.

    (order, supplier) repeats inside an order, so the feed carries natural duplicates.
    The projection is one ``selectExpr`` (parsed once on the JVM side).
    """
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    j = li.join(s, li.l_suppkey == s.s_suppkey).selectExpr(
        "*", "CAST(l_quantity AS INT) AS qty", "l_linenumber AS ln",
        "CAST(round(l_tax * 100) AS INT) AS tax100", "CAST(round(l_discount * 100) AS INT) AS disc100")
    return j.selectExpr(
        "l_orderkey AS game_id",
        "s_nationkey AS team_id",
        "concat('T', lpad(CAST(s_nationkey AS STRING), 2, '0')) AS team_abbreviation",
        "l_suppkey AS player_id",
        "s_name AS player_name",
        "CASE ln WHEN 1 THEN 'C' WHEN 2 THEN 'F' WHEN 3 THEN 'G' END AS start_position",
        """CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'DNP - Coach''s Decision'
                WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'DND - Injury/Illness'
                WHEN l_returnflag = 'A' AND ln = 7 THEN 'NWT - Not With Team' END AS comment""",
        """CASE WHEN l_returnflag = 'R' THEN CAST(NULL AS STRING) WHEN ln = 7 THEN ''
                WHEN ln = 6 THEN CAST(qty AS STRING)
                ELSE concat(CAST(qty AS STRING), ':', lpad(CAST(ln * 8 AS STRING), 2, '0')) END AS min""",
        "CAST(qty / 3 AS INT) AS fgm",
        "CAST(qty / 3 AS INT) * 2 + ln AS fga",
        "CAST(ln / 2 AS INT) AS fg3m",
        "ln AS fg3a",
        "tax100 AS ftm",
        "tax100 + 1 AS fta",
        "ln AS oreb",
        "disc100 AS dreb",
        "ln + disc100 AS reb",
        "pmod(qty, 7) AS ast",
        "pmod(qty, 3) AS stl",
        "pmod(qty + ln, 4) AS blk",
        "pmod(ln * 3, 5) AS `TO`",
        "pmod(qty, 6) AS pf",
        "qty AS pts",
        "qty - 25 AS plus_minus",
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as teams, delivered twice (the second copy with an older arena name)."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])

    def shape(arena_suffix: str) -> DataFrame:
        return n.select(
            F.col("n_nationkey").alias("team_id"),
            F.concat(F.lit("T"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("abbreviation"),
            F.col("n_name").alias("nickname"),
            F.concat(F.lit("City "), F.col("n_nationkey").cast("string")).alias("city"),
            F.concat(F.lit("Arena "), F.col("n_regionkey").cast("string"), F.lit(arena_suffix)).alias("arena"),
            (F.lit(1946) + F.col("n_nationkey")).alias("yearfounded"),
        )

    return shape("").unionByName(shape(" (old)"))


def events(spark: SparkSession, sf_dir: str, shift_days: int = 0, first: dt.date | None = None,
           last: dt.date | None = None) -> DataFrame:
    """events as web hits: host = device's site, device = props.k.

    Collection is at-least-once: hits in the first six minutes of every hour are
    delivered twice (exact copies), and anonymous sign-ups in the last six
    minutes of an hour carry no user.  ``shift_days`` moves the clock (used to
    span a month boundary); ``first`` and ``last`` are event days after the shift,
    given to the scan as a range of the stored clock.
    """
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    clock = lambda d: F.lit(dt.datetime.combine(d - dt.timedelta(days=shift_days), dt.time())).cast("timestamp_ntz")
    if first is not None:
        e = e.where(F.col("ts") >= clock(first))
    if last is not None:
        e = e.where(F.col("ts") < clock(last + dt.timedelta(days=1)))
    device = F.get_json_object("props", "$.k").cast("bigint")
    ts = F.col("ts") if shift_days == 0 else F.col("ts") + F.make_dt_interval(F.lit(shift_days))
    # one scan; a re-delivered hit is a second copy emitted by a narrow explode
    copies = F.sequence(F.lit(1), F.when(F.minute("ts") < 6, 2).otherwise(1))
    return e.select(
        F.col("event_id"),
        F.when((F.col("event_type") == "signup") & (F.minute("ts") >= 54), F.lit(None).cast("bigint"))
        .otherwise(F.col("user_id")).alias("user_id"),
        device.alias("device_id"),
        F.concat(F.lit("host-"), device.cast("string")).alias("host"),
        F.col("event_type"),
        ts.alias("event_time"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


# fixed values: browser names assigned to devices
BROWSERS = ("chrome", "firefox", "safari")


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per device seen in events (delivered twice), with its browser."""
    ev = events(spark, sf_dir).select("device_id").where(F.col("device_id").isNotNull()).distinct()
    browser = F.element_at(F.array(*[F.lit(b) for b in BROWSERS]), _int(F.pmod(F.col("device_id"), F.lit(len(BROWSERS)))) + 1)
    d = ev.select("device_id", browser.alias("browser_type"))
    return d.unionByName(d)
