"""Match ids and keys through stored tables: nothing changed, inserted twice or lost."""

from __future__ import annotations

import json
import os

import pytest

from touchline.operators import ball, tables
from touchline.plans import jobs
from touchline.session import shared_dir
from touchline.sources import files

COLS = "side string, player_id string, v double, match_date string"
KEYS = ["match_date", "side", "player_id"]


@pytest.mark.parametrize("ids", [["0012", "0013"], ["2024-01-01 15:00:00", "2024-01-01 18:00:00"], ["2024-01-01", "2024-01-02"],
                                 ["1e3", "7"], ["M-17", "a/b c%"], ["true", None], ["0012", None]])
def test_ids_come_back_as_they_were(spark, ids):
    path = shared_dir(spark, "ids")
    rows = spark.createDataFrame([("home", f"p{i}", float(i), m) for i, m in enumerate(ids)], COLS)
    for _ in range(3):
        tables.merge_insert_only(spark, rows, path, KEYS)
    got = files.read_table(spark, path)
    assert dict(got.dtypes)["match_date"] == "string"
    assert sorted(map(str, got.select("match_date", "player_id").collect())) == sorted(map(str, rows.select("match_date", "player_id").collect()))


def test_a_key_twice_in_one_load_is_stored_once(spark):
    path, again = shared_dir(spark, "twice"), shared_dir(spark, "twice")
    rows = [("home", "p1", 9.0, "0012"), ("home", "p1", 1.0, "0012"), ("home", None, 2.0, "0012"), ("home", None, 2.0, "0012"), (None, "p1", None, "0013"), (None, "p1", 3.0, "0013")]
    tables.merge_insert_only(spark, spark.createDataFrame(rows, COLS), path, KEYS)
    tables.merge_insert_only(spark, spark.createDataFrame(rows[::-1], COLS).repartition(4), path, KEYS)
    tables.merge_insert_only(spark, spark.createDataFrame(rows[::-1], COLS).repartition(3), again, KEYS)
    want = sorted(map(str, [("home", "p1", 1.0, "0012"), ("home", None, 2.0, "0012"), (None, "p1", None, "0013")]))
    assert sorted(str(tuple(r)) for r in files.read_table(spark, path).select("side", "player_id", "v", "match_date").collect()) == want
    assert sorted(str(tuple(r)) for r in files.read_table(spark, again).select("side", "player_id", "v", "match_date").collect()) == want


def test_null_keys_are_loaded_once(spark):
    path = shared_dir(spark, "nulls")
    rows = spark.createDataFrame([("home", "p1", 1.0, None), ("home", "p2", 1.0, "x")], COLS)
    assert tables.incremental_load(spark, rows, path, lambda d: d).count() == 2
    assert files.read_table(spark, path).count() == 2
    assert tables.incremental_load(spark, rows, path, lambda d: d).count() == 0
    assert files.read_table(spark, path).count() == 2


def test_features_as_of_with_real_match_ids(spark):
    rows = spark.createDataFrame([("home", "p1", 1.0, "M-17"), ("home", "p1", 2.0, "M-2"), ("home", "p2", 3.0, "2024-01-05")], COLS)
    days = spark.createDataFrame([("M-17", "2024-01-10"), ("M-2", "2024-02-01")], "match_id string, kickoff string")
    got = {r.player_id: r.v for r in tables.features_as_of(rows, "2024-01-20", days=days).collect()}
    assert got == {"p1": 1.0, "p2": 3.0}
    with pytest.raises(Exception, match="match without a day"):
        tables.features_as_of(rows, "2024-01-20").collect()


def test_matches_without_metadata_have_the_default_pitch(spark):
    rows = spark.createDataFrame([("a", 45.0, 0.0), ("b", 45.0, 0.0), ("c", 45.0, 0.0)], "match_id string, x double, y double")
    meta = spark.createDataFrame([("a", 100.0, 64.0), ("c", None, None)], "match_id string, pitch_length double, pitch_width double")
    got = {r.match_id: (r.pitch_length, r.n_times_inside_box) for r in ball.ball_in_box_by_pitch(rows, meta).collect()}
    assert got == {"a": (100.0, 1), "b": (104.85, 1), "c": (104.85, 1)}


def frame(match, i):
    player = {"playerId": "p1", "speed": 1.0, "xyz": [1.0, 2.0, 0.0]}
    return {"matchId": match, "period": 1, "frameIdx": i, "gameClock": i * 0.04, "wallClock": 1_704_067_200_000 + 40 * i, "live": True, "lastTouch": "home",
            "homePlayers": [player], "awayPlayers": [], "ball": {"xyz": [0.0, 0.0, 0.0], "speed": 1.0}}


def test_ingest_twice_with_ids_that_look_like_numbers_and_times(spark, tmp_path):
    src = tmp_path / "frames.json"
    src.write_text("".join(json.dumps(frame(m, i)) + "\n" for m in ("0012", "2024-01-01 15:00:00", "2024-01-01 18:00:00") for i in range(5)))
    players, balls = shared_dir(spark, "p"), shared_dir(spark, "b")
    for _ in range(2):
        jobs.ingest(spark, str(src), None, players, balls)
    for path in (players, balls):
        counts = {r["match_date"]: r["count"] for r in files.read_table(spark, path).groupBy("match_date").count().collect()}
        assert counts == {"0012": 5, "2024-01-01 15:00:00": 5, "2024-01-01 18:00:00": 5}


def test_two_feeds_of_a_day_are_two_matches_and_bad_lines_are_kept(spark, tmp_path):
    feed, sink = tmp_path / "feed", str(tmp_path / "sink")
    os.makedirs(feed)
    for m in ("M-1", "M-2"):
        (feed / f"{m}.dat").write_text("".join(f"{1_704_067_200_000 + i * 40}:F{i}|p:1,2,0,1,A,Alive;:\n" for i in range(4)) + "no clock\n")
    jobs.main(["stream", "--path", str(feed), "--sink", sink, "--checkpoint", str(tmp_path / "c"), "--available-now", "--match-id-from-file", r"([^/]+)\.dat$"])
    stored = spark.read.parquet(sink + "/batch_id=0").groupBy("match_id").count().collect()
    assert {r.match_id: r["count"] for r in stored} == {"M-1": 4, "M-2": 4}
    assert spark.read.parquet(sink + "_rejects").count() == 2


def test_refresh_command(spark, tmp_path):
    src = tmp_path / "frames.json"
    src.write_text("".join(json.dumps(frame("0012", i)) + "\n" for i in range(3)))
    paths = [str(tmp_path / n) for n in ("players", "balls", "pf", "bf")]
    jobs.ingest(spark, str(src), None, *paths[:2])
    args = [f for pair in zip(("--players", "--ball", "--player-features", "--ball-features"), paths) for f in pair]
    jobs.main(["features", *args])
    late = tmp_path / "late.json"
    fast = frame("0012", 9)
    fast["homePlayers"][0]["speed"] = 8.0
    late.write_text(json.dumps(fast) + "\n")
    jobs.ingest(spark, str(late), None, *paths[:2])
    jobs.main(["refresh", *args, "--matches", "0012"])
    got = files.read_table(spark, paths[2]).collect()
    assert [(r.match_date, r.player_max_speed) for r in got] == [("0012", 8.0)]
