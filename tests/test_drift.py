"""Schema gate against counts in plain Python."""

from __future__ import annotations

import json

from touchline import schemas
from touchline.operators import drift


def frame(i, **changes):
    player = {"playerId": "p", "speed": 1.5, "xyz": [1.0, 2, 0.0]}
    out = {"matchId": "m", "period": 1, "frameIdx": i, "gameClock": 0.5, "wallClock": 1_704_067_200_000, "live": True, "lastTouch": "home",
           "homePlayers": [player, dict(player)], "awayPlayers": [], "ball": {"xyz": [0.0, 1, 2], "speed": 3}}
    out.update(changes)
    return {k: v for k, v in out.items() if v != "DROP"}


def report(spark, records):
    lines = spark.createDataFrame([(r if isinstance(r, str) or r is None else json.dumps(r),) for r in records], "value string")
    return {(r.match_id, r.path, r.problem, r.found): r.n for r in drift.drift_report(lines).collect()}


def test_records_of_the_contract(spark):
    assert report(spark, [frame(i) for i in range(5)]) == {}
    assert report(spark, [frame(1, matchId="DROP")]) == {}  # optional
    assert report(spark, [frame(1, lastTouch=None, ball=None, homePlayers=[])]) == {}  # nulls and empty lists


def test_every_kind_of_drift(spark):
    home = [{"playerId": 7, "xyz": [1.0, "a"]}, {"playerId": "p", "speed": None, "xyz": [], "shirt": {"no": 4, "sizes": [1, 2]}}]
    records = [frame(1, weather="rain"), frame(2, weather={"wind": [1, 2, 3]}), frame(3, gameClock="0.5"), frame(4, period=1.5), frame(5, live="DROP", lastTouch="DROP"),
               frame(6, homePlayers=home), frame(7, ball=[1, 2]), frame(8, matchId="other", ball={"speed": "fast"}), "{cut", "", None, "5", "[1]"]
    assert report(spark, records) == {
        ("m", "$.weather", "unknown", "STRING"): 1, ("m", "$.weather", "unknown", "OBJECT"): 1,
        ("m", "$.gameClock", "retyped", "STRING"): 1, ("m", "$.period", "retyped", "DECIMAL"): 1,
        ("m", "$.live", "missing", None): 1, ("m", "$.lastTouch", "missing", None): 1,
        ("m", "$.homePlayers[].playerId", "retyped", "BIGINT"): 1, ("m", "$.homePlayers[].xyz[]", "retyped", "STRING"): 1,
        ("m", "$.homePlayers[].speed", "missing", None): 1, ("m", "$.homePlayers[].shirt", "unknown", "OBJECT"): 1,
        ("m", "$.ball", "retyped", "ARRAY"): 1,
        ("other", "$.ball.speed", "retyped", "STRING"): 1, ("other", "$.ball.xyz", "missing", None): 1,
        (None, "$", "unparsable", None): 3, (None, "$", "retyped", "BIGINT"): 1, (None, "$", "retyped", "ARRAY"): 1,
    }


def test_counts_are_those_of_the_records(spark):
    records = [frame(i, homePlayers=[{"playerId": "p", "speed": 1.0, "xyz": [0.0] * (j % 4)} for j in range(i % 6)]) for i in range(40)]
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    got = {}
    for r in drift.field_counts(lines).collect():
        got[r.path] = got.get(r.path, 0) + r.n
    players = [p for r in records for p in r["homePlayers"]]
    assert got["$"] == 40 and got["$.homePlayers"] == 40 and got["$.ball.xyz[]"] == 120
    assert got["$.homePlayers[]"] == got["$.homePlayers[].xyz"] == len(players)
    assert got["$.homePlayers[].xyz[]"] == sum(len(p["xyz"]) for p in players) and "$.awayPlayers[]" not in got


def test_contract_paths():
    paths = {p: (parent, kinds) for p, parent, kinds in drift.contract_paths(schemas.FRAME)}
    assert paths["$.ball.xyz[]"] == (None, ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"]) and paths["$.frameIdx"] == ("$", ["BIGINT"])
    assert paths["$.homePlayers[]"] == (None, ["OBJECT"]) and paths["$.homePlayers[].playerId"] == ("$.homePlayers[]", ["STRING"])


def test_no_lines(spark):
    assert report(spark, []) == {}
