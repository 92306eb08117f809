"""Property graph from relational feeds (operators E1-E7, T8).

Vertices are ``(identifier, type, properties JSON)``; edges are
``(subject_identifier, subject_type, object_identifier, object_type, edge_type,
properties JSON)``.  Both are plain DataFrames; reads join them on the two-part
key and pull typed values out of the JSON with ``get_json_object`` + ``try_cast``.

Pair edges (E5) are a self equi-join on the game with the residual
``id1 > id2`` (one direction per pair), directly followed by the aggregate on
(id1, id2, edge type).  Spark runs the join and the partial aggregate in the
same stage, so a game's pairs are summed before anything is shuffled.  Games
are measured first: those of more than ``HEAVY`` players are cut into blocks of
players, and every pair of blocks is joined on its own.

Graph tables that are read often are stored with ``typed_properties``: the keys
that reads use, taken out of the JSON bag once, as typed columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimfold.functions.props import as_map, json_object, prop
from dimfold.operators.dedup import keep_first

# fixed values: the closed vertex and edge type sets
VERTEX_TYPES = ("player", "team", "game")
EDGE_TYPES = ("plays_against", "shares_team", "plays_in", "plays_on")


def _vertex(identifier: Column, vtype: str, properties: Column) -> list[Column]:
    return [identifier.cast("string").alias("identifier"), F.lit(vtype).alias("type"), properties.alias("properties")]


# fixed values: the box-score columns the graph uses
GRAPH_COLS = ("game_id", "player_id", "team_id", "team_abbreviation", "player_name", "start_position", "pts")


def player_game_rows(details: DataFrame) -> DataFrame:
    """One box-score row per (player, game), first by the graph's own columns.

    Projecting before de-duplicating keeps the sort and the shuffle to seven columns.  The game leads the sort: a game
    has few rows, a player many, so the first column settles nearly every comparison.
    """
    return keep_first(details.select(*GRAPH_COLS), ["game_id", "player_id"])


def game_vertices(games: DataFrame) -> DataFrame:
    """A vertex per game with its score and the winning team."""
    g = keep_first(games, ["game_id"])
    winner = F.when(F.col("home_team_wins") == 1, F.col("home_team_id")).otherwise(F.col("visitor_team_id"))
    return g.select(*_vertex(F.col("game_id"), "game", json_object(
        pts_home=F.col("pts_home"), pts_away=F.col("pts_away"), winning_team=winner)))


def player_vertices(details: DataFrame, deduplicate: bool = True) -> DataFrame:
    """A vertex per player with name, games, points and the sorted set of teams."""
    d = player_game_rows(details) if deduplicate else details
    agg = d.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"),
        F.count(F.lit(1)).alias("number_of_games"),
        F.sum("pts").alias("total_points"),
        F.sort_array(F.collect_set("team_id")).alias("teams"),
    )
    return agg.select(*_vertex(F.col("player_id"), "player", json_object(
        player_name=F.col("player_name"), number_of_games=F.col("number_of_games"),
        total_points=F.col("total_points"), teams=F.col("teams"))))


def team_vertices(teams: DataFrame) -> DataFrame:
    """A vertex per (de-duplicated) team."""
    t = keep_first(teams, ["team_id"])
    return t.select(*_vertex(F.col("team_id"), "team", json_object(
        abbreviation=F.col("abbreviation"), nickname=F.col("nickname"), city=F.col("city"),
        arena=F.col("arena"), year_founded=F.col("yearfounded"))))


def plays_in_edges(details: DataFrame, deduplicate: bool = True) -> DataFrame:
    """Player -> game edges with the player's line in that game."""
    d = player_game_rows(details) if deduplicate else details
    return d.select(
        F.col("player_id").cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("game_id").cast("string").alias("object_identifier"),
        F.lit("game").alias("object_type"),
        F.lit("plays_in").alias("edge_type"),
        json_object(start_position=F.col("start_position"), pts=F.col("pts"), team_id=F.col("team_id"),
                    team_abbreviation=F.col("team_abbreviation")).alias("properties"),
    )


#: players of a game from which its pairs are cut into blocks, and players of a block
HEAVY = 256


def _light_pairs(rows: DataFrame) -> DataFrame:
    a, b = rows.alias("a"), rows.alias("b")
    return a.join(b, (F.col("a.game_id") == F.col("b.game_id")) & (F.col("a.player_id") > F.col("b.player_id")))


def _heavy_pairs(rows: DataFrame) -> DataFrame:
    """``rows`` have their game's number of ``blocks``: a row goes to the cells of its block and every other, and each
    cell joins its two blocks (or a block with itself), so a cell has at most about 2 HEAVY rows whatever the game's size."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("player_id"), F.col("blocks")).cast("int"))
    cells = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
    a, b = cells.alias("a"), cells.alias("b")
    met = (F.col("a.own") != F.col("b.own")) | (F.col("a.lo") == F.col("a.hi"))
    return a.join(b, (F.col("a.game_id") == F.col("b.game_id")) & (F.col("a.lo") == F.col("b.lo")) & (F.col("a.hi") == F.col("b.hi"))
                  & (F.col("a.player_id") > F.col("b.player_id")) & met)


def pair_edges(details: DataFrame, deduplicate: bool = True, heavy: int = HEAVY) -> DataFrame:
    """E5: player-player edges per co-played game, one direction (id1 > id2).

    ``shares_team`` when both were on the same team in that game, otherwise
    ``plays_against``; properties count the games and sum each side's points.
    Games of up to ``heavy`` players are joined as they are, larger ones in pairs of blocks.
    """
    d = (player_game_rows(details) if deduplicate else details).select("game_id", "player_id", "player_name", "team_abbreviation", "pts")
    large = (d.groupBy("game_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy)
             .select("game_id", F.ceil(F.col("n") / heavy).cast("int").alias("blocks")))
    sides = ["a.player_id", "b.player_id", "a.team_abbreviation", "b.team_abbreviation", "a.player_name", "b.player_name", "a.pts", "b.pts"]
    flat = [F.col(c).alias(c.replace(".", "_")) for c in sides]
    pairs = (_light_pairs(d.join(large, "game_id", "left_anti")).select(*flat)
             .unionByName(_heavy_pairs(d.join(large, "game_id")).select(*flat)))
    # the pairs are shuffled with a flag, the label is written out on the sums
    same_team = F.coalesce(F.col("a_team_abbreviation") == F.col("b_team_abbreviation"), F.lit(False))
    agg = pairs.groupBy(
        F.col("a_player_id").alias("subject_player_id"),
        F.col("b_player_id").alias("object_player_id"),
        same_team.alias("same_team"),
    ).agg(
        F.max("a_player_name").alias("subject_player_name"),
        F.max("b_player_name").alias("object_player_name"),
        F.count(F.lit(1)).alias("num_games"),
        F.sum("a_pts").alias("subject_points"),
        F.sum("b_pts").alias("object_points"),
    )
    return agg.select(
        F.col("subject_player_id").cast("string").alias("subject_identifier"),
        F.lit("player").alias("subject_type"),
        F.col("object_player_id").cast("string").alias("object_identifier"),
        F.lit("player").alias("object_type"),
        F.when(F.col("same_team"), F.lit("shares_team")).otherwise(F.lit("plays_against")).alias("edge_type"),
        json_object(num_games=F.col("num_games"), subject_points=F.col("subject_points"),
                    object_points=F.col("object_points")).alias("properties"),
    )


# fixed values: the property keys that E6 and E7 read, by table
PLAYER_PROPERTIES = {"player_name": "string", "number_of_games": "double", "total_points": "double"}
PLAYS_IN_PROPERTIES = {"pts": "int"}
PAIR_PROPERTIES = {"num_games": "bigint", "subject_points": "bigint"}


def typed_properties(rows: DataFrame, keys: dict[str, str], prefix: str = "p_") -> DataFrame:
    """The table with the named keys of its JSON bag as typed columns, NULL where a key is missing or of another type.

    The bag is parsed once a row, into a variant, when the table is stored; reads then need neither the bag nor a parser.
    """
    bag = rows.withColumn("_v", F.try_parse_json("properties"))
    return bag.select(*rows.columns, *[F.try_variant_get("_v", f"$.{k}", kind).alias(prefix + k) for k, kind in keys.items()])


def _subject_join(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    v, e = vertices.alias("v"), edges.alias("e")
    return v.join(e, (F.col("e.subject_identifier") == F.col("v.identifier")) & (F.col("e.subject_type") == F.col("v.type")))


def max_property(vertices: DataFrame, edges: DataFrame, name_key: str = "player_name", value_key: str = "pts",
                 ordered: bool = True) -> DataFrame:
    """Per vertex name, the largest integer ``value_key`` found on its outgoing edges."""
    j = _subject_join(vertices, edges)
    out = j.groupBy(prop("v.properties", name_key).alias(name_key)).agg(
        F.max(prop("e.properties", value_key).try_cast("int")).alias(f"max_{value_key}"))
    return out.orderBy(F.col(f"max_{value_key}").desc_nulls_first()) if ordered else out


def pair_vs_career(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """For each player-player edge, career points per game vs. points per game against that player."""
    j = _subject_join(vertices, edges).where(F.col("e.object_type") == "player")

    def num(p: str, key: str) -> Column:
        return prop(p, key).try_cast("double")

    return j.select(
        prop("v.properties", "player_name").alias("subject_player_name"),
        F.col("e.object_identifier").alias("object_identifier"),
        (num("v.properties", "total_points") / F.nullif(num("v.properties", "number_of_games"), F.lit(0.0)))
        .alias("avg_pts_career"),
        prop("e.properties", "subject_points").alias("pts_vs_object"),
        prop("e.properties", "num_games").alias("num_games_vs_object"),
        (num("e.properties", "subject_points") / F.nullif(num("e.properties", "num_games"), F.lit(0.0)))
        .alias("avg_pts_vs_object"),
    )


def max_typed_property(vertices: DataFrame, edges: DataFrame, name_key: str = "player_name", value_key: str = "pts",
                       ordered: bool = True) -> DataFrame:
    """E6 over stored tables with typed properties."""
    j = _subject_join(vertices.select("identifier", "type", F.col(f"p_{name_key}").alias("name")),
                      edges.select("subject_identifier", "subject_type", F.col(f"p_{value_key}").alias("value")))
    out = j.groupBy(F.col("name").alias(name_key)).agg(F.max("value").alias(f"max_{value_key}"))
    return out.orderBy(F.col(f"max_{value_key}").desc_nulls_first()) if ordered else out


def typed_pair_vs_career(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """E7 over stored tables with typed properties."""
    v = vertices.select("identifier", "type", F.col("p_player_name").alias("subject_player_name"),
                        (F.col("p_total_points") / F.nullif("p_number_of_games", F.lit(0.0))).alias("avg_pts_career"))
    e = edges.where(F.col("object_type") == "player").select("subject_identifier", "subject_type", "object_identifier",
                                                            F.col("p_subject_points").alias("points"), F.col("p_num_games").alias("games"))
    return _subject_join(v, e).select(
        "subject_player_name", "object_identifier", "avg_pts_career",
        F.col("points").cast("string").alias("pts_vs_object"), F.col("games").cast("string").alias("num_games_vs_object"),
        (F.col("points").cast("double") / F.nullif(F.col("games").cast("double"), F.lit(0.0))).alias("avg_pts_vs_object"))


def property_map(graph_rows: DataFrame, keep: tuple[str, ...] = ("identifier", "type")) -> DataFrame:
    """Properties as ``map<string,string>`` (the identifier/type/MAP vertex form)."""
    return graph_rows.select(*keep, as_map("properties").alias("properties"))
