import json

from conftest import rows
from dimfold.operators import graph
from dimfold.functions.props import prop

DETAILS = "game_id long, team_id int, team_abbreviation string, player_id long, player_name string, " \
          "start_position string, pts int"


def _d(spark, data):
    return spark.createDataFrame(data, DETAILS)


def test_pair_edges_one_direction_homonyms_and_labels(spark):
    d = _d(spark, [
        (1, 1, "A", 10, "Sam", "C", 5), (1, 1, "A", 11, "Sam", None, 7), (1, 2, "B", 12, "Kim", None, 1),
        (2, 1, "A", 10, "Sam", "C", 3), (2, 1, "A", 11, "Sam", "G", 4), (2, None, None, 12, "Kim", None, 2),
        (2, 1, "A", 10, "Sam", "C", 3),                                  # duplicate row of (player, game)
    ])
    e = graph.pair_edges(d)
    got = {(r.subject_identifier, r.object_identifier, r.edge_type): json.loads(r.properties) for r in e.collect()}
    assert got[("11", "10", "shares_team")] == {"num_games": 2, "subject_points": 11, "object_points": 8}
    assert got[("12", "10", "plays_against")]["num_games"] == 2     # NULL team -> plays_against
    assert all(int(s) > int(o) for s, o, _ in got)


def test_vertices_and_reads(spark):
    d = _d(spark, [(1, 1, "A", 10, "Sam", "C", 5), (2, 2, "B", 10, "Sam", None, 9), (1, 1, "A", 11, "Kim", None, 0)])
    pv = graph.player_vertices(d)
    p10 = json.loads(pv.where("identifier = '10'").first().properties)
    assert p10 == {"player_name": "Sam", "number_of_games": 2, "total_points": 14, "teams": [1, 2]}
    edges = graph.plays_in_edges(d).unionByName(graph.pair_edges(d))
    mx = {r.player_name: r.max_pts for r in graph.max_property(pv, edges).collect()}
    assert mx == {"Sam": 9, "Kim": 0}
    pc = {r.object_identifier: r for r in graph.pair_vs_career(pv, edges).collect()}
    assert pc["10"].avg_pts_career == 0.0 and pc["10"].avg_pts_vs_object == 0.0
    e0 = edges.where("edge_type = 'plays_in' and subject_identifier = '11'").select(
        prop("properties", "start_position").alias("sp")).first()
    assert e0.sp is None                                             # NULL kept as JSON null


def test_property_map(spark):
    d = _d(spark, [(1, 1, "A", 10, "Sam", "C", 5)])
    m = graph.property_map(graph.player_vertices(d)).first().properties
    assert m["teams"] == "[1]" and m["number_of_games"] == "1"
