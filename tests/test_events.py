"""Live events: ordering, restarts and null handling (FIXTURES F10)."""

from __future__ import annotations

from touchline.operators import ball, events

COLS = ("match_id string, wall_ms long, frame_idx long, period int, game_clock double, ball_status string, "
        "x double, y double, z double, ball_speed double, ball_team string")


def _events(spark, rows):
    full = [("m1", ms, fi, 1, 0.0, st, x, y, 0.0, 1.0, team) for (ms, fi, st, x, y, team) in rows]
    flagged = ball.ball_flags(spark.createDataFrame(full, COLS))
    return sorted(events.live_events(flagged).collect(), key=lambda r: (r.wall_ms, r.frame_idx, r.seq))


def test_two_changes_in_one_row_in_seq_order(spark):
    out = _events(spark, [(1000, 1, "Dead", 45.0, 0.0, "A")])
    assert [(r.seq, r.kind) for r in out] == [(1, "STATUS_CHANGED"), (2, "BOX_ENTERED")]
    assert out[0].message.endswith("Ball change status from Alive to Dead")
    assert out[1].message.startswith("Timestamp: 1970-01-01 00:00:01.000; Action is coming!")


def test_ball_out_side_line_goal_line_and_both(spark):
    rows = [
        (1000, 1, "Alive", 10.0, 40.0, "A"), (2000, 2, "Alive", 0.0, 0.0, "A"),
        (3000, 3, "Alive", 60.0, 5.0, "B"), (4000, 4, "Alive", 0.0, 0.0, "B"),
        (5000, 5, "Alive", -60.0, -40.0, "A"),
    ]
    out = [r for r in _events(spark, rows) if r.kind == "FIELD_LEFT"]
    assert [(r.restart, r.team) for r in out] == [("throw-in", "home"), ("corner", "away"), ("corner", "home")]
    assert "throw-in for home team" in out[0].message


def test_null_position_keeps_state(spark):
    rows = [(1000, 1, "Alive", 45.0, 0.0, "A"), (2000, 2, "Alive", None, None, "A"), (3000, 3, "Alive", 46.0, 0.0, "A")]
    out = _events(spark, rows)
    assert [(r.wall_ms, r.kind) for r in out] == [(1000, "BOX_ENTERED")]


def test_state_carries_across_minute_buckets(spark):
    rows = [(0, 1, "Dead", 0.0, 0.0, "A"), (600_000, 2, "Dead", 0.0, 0.0, "A"), (900_000, 3, "Alive", 0.0, 0.0, "A")]
    out = _events(spark, rows)
    assert [(r.wall_ms, r.old_value, r.new_value) for r in out] == [(0, "Alive", "Dead"), (900_000, "Dead", "Alive")]
