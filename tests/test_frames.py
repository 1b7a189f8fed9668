"""Nested frames: one-sided frames, dedup parity, quality gate."""

from __future__ import annotations

import json
import os

from touchline import schemas
from touchline.operators import frames
from touchline.session import shared_dir
from touchline.sources import files


def _frame(idx, home, away, ball_xyz=(1.0, 2.0, 0.0), period=1):
    p = lambda pid: {"playerId": pid, "speed": 1.5, "xyz": [0.5, -0.5, 0.0]}
    return {
        "period": period, "frameIdx": idx, "gameClock": idx * 0.04, "wallClock": 1_700_000_000_000 + idx * 40,
        "live": True, "lastTouch": "home", "homePlayers": [p(x) for x in home], "awayPlayers": [p(x) for x in away],
        "ball": {"xyz": list(ball_xyz), "speed": 3.0},
    }


def _write(spark, lines):
    path = shared_dir(spark, "frames-test")
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_one_team_empty_keeps_other_team(spark):
    path = _write(spark, [json.dumps(_frame(1, ["h1", "h2"], [])), json.dumps(_frame(2, ["h1"], ["a1"]))])
    fr = files.read_frames(spark, path)
    players = frames.unified_players(fr)
    assert players.count() == 4
    # Reference parity: the one-sided frame is lost, as in its pair rows.
    assert sorted((r.frame_idx, r.player_id) for r in frames.dedup_players(fr).collect()) == [(2, "a1"), (2, "h1")]


def test_repeated_lines_collapse_in_dedup(spark):
    line = json.dumps(_frame(3, ["h1"], ["a1"]))
    fr = files.read_frames(spark, _write(spark, [line, line]))
    assert frames.unified_players(frames.dedup_frames(fr)).count() == 2
    assert frames.dedup_players(fr).count() == 2


def test_quality_gate_routes_bad_frames(spark):
    lines = [
        json.dumps(_frame(1, ["h1"], ["a1"])),
        '{"period": 1, "frameIdx": 2, "gameClock": "oops"',
        json.dumps(_frame(3, ["h1"], ["a1"], ball_xyz=(1.0,))),
        json.dumps(_frame(4, ["h1"], ["a1"], period=7)),
    ]
    fr = files.read_frames(spark, _write(spark, lines), keep_corrupt=True)
    good, bad = frames.quality_split(fr)
    assert [r.frameIdx for r in good.collect()] == [1]
    reasons = sorted(tuple(r.reasons) for r in bad.collect())
    assert ("corrupt", "missing_clock", "bad_period", "short_ball_xyz") in reasons
    assert ("short_ball_xyz",) in reasons and ("bad_period",) in reasons
    assert schemas.CORRUPT in fr.columns


def test_dedup_parity_equals_pairwise_explode_on_small_fixture(spark):
    """Brute force: the reference's double explode (all home x away pairs per
    frame), home columns, de-duplicated, equals our pair-free dedup."""
    from pyspark.sql import functions as F

    lines = [
        json.dumps(_frame(1, ["h1", "h2", "h3"], ["a1", "a2"])),
        json.dumps(_frame(2, ["h1"], [])),
        json.dumps(_frame(3, [], ["a1"])),
        json.dumps(_frame(4, ["h2", "h2"], ["a3"])),
    ]
    fr = files.read_frames(spark, _write(spark, lines))
    pairs = (
        fr.withColumn("hp", F.explode("homePlayers")).withColumn("ap", F.explode("awayPlayers"))
        .select(F.col("frameIdx").alias("frame_idx"), F.col("hp.playerId").alias("player_id"))
        .dropDuplicates()
    )
    ours = frames.split_by_side(frames.dedup_players(fr), "home").select("frame_idx", "player_id")
    assert sorted(pairs.collect()) == sorted(ours.collect())
    # And without the pair rule every player row is kept.
    assert frames.unified_players(fr).count() == 10
