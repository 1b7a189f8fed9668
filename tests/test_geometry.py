"""Penalty area, field and restart rules on edge positions (FIXTURES F10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions import geometry as g

HALF_L = g.PITCH_LENGTH_M / 2
HALF_W = g.PITCH_WIDTH_M / 2
INNER = HALF_L - g.PENALTY_AREA_LENGTH_M
AREA_W = g.PENALTY_AREA_WIDTH_M / 2


def _flags(spark, points, **kw):
    df = spark.createDataFrame(points, "x double, y double")
    return [
        (r.box, r.left, r.field)
        for r in df.select(
            g.in_penalty_area(F.col("x"), F.col("y"), **kw).alias("box"),
            g.in_penalty_area(F.col("x"), F.col("y"), ends="left", **kw).alias("left"),
            g.in_field(F.col("x"), F.col("y")).alias("field"),
        ).collect()
    ]


def test_right_box_inside_both_ends_only(spark):
    assert _flags(spark, [(45.0, 0.0)]) == [(True, False, True)]


def test_left_box_inside_for_both_modes(spark):
    assert _flags(spark, [(-45.0, 0.0)]) == [(True, True, True)]


def test_lines_are_outside(spark):
    pts = [(HALF_L, 0.0), (INNER, 0.0), (45.0, AREA_W), (-45.0, -AREA_W), (0.0, HALF_W)]
    flags = _flags(spark, pts)
    assert [f[0] for f in flags] == [False] * 5
    assert flags[0][2] is False and flags[4][2] is False


def test_null_and_short_positions_give_null(spark):
    df = spark.createDataFrame([([1.0],), (None,), ([None, 1.0, 0.0],)], "xyz array<double>")
    x, y = g.xy(F.col("xyz"))
    rows = df.select(g.in_penalty_area(x, y).alias("b"), g.in_field(x, y).alias("f")).collect()
    assert [(r.b, r.f) for r in rows] == [(None, None)] * 3


def test_restart_kinds(spark):
    df = spark.createDataFrame(
        [(10.0, 40.0, "A"), (60.0, 5.0, "B"), (60.0, -40.0, "A")], "x double, y double, team string"
    )
    sx, sy = g.restart_spot(F.col("x"), F.col("y"))
    rows = df.select(
        g.restart_kind(F.col("x")).alias("k"), g.restart_team(F.col("team")).alias("t"),
        sx.alias("sx"), sy.alias("sy"),
    ).collect()
    assert [(r.k, r.t) for r in rows] == [("throw-in", "home"), ("corner", "away"), ("corner", "home")]
    assert (rows[0].sx, rows[0].sy) == (10.0, HALF_W)
    assert (rows[1].sx, rows[1].sy) == (HALF_L, HALF_W)
    assert (rows[2].sx, rows[2].sy) == (HALF_L, -HALF_W)


def test_flags_match_plain_python_rules_on_random_points(spark):
    """Brute force: the Column expressions against the rules written in Python."""
    import random

    rnd = random.Random(3)
    pts = [(rnd.uniform(-60, 60), rnd.uniform(-40, 40)) for _ in range(2000)]
    pts += [(HALF_L, 0.0), (-INNER, AREA_W - 1e-9), (INNER + 1e-9, 0.0), (0.0, -HALF_W)]
    df = spark.createDataFrame(pts, "x double, y double")
    got = df.select(
        "x", "y",
        g.in_penalty_area(F.col("x"), F.col("y")).alias("box"),
        g.in_penalty_area(F.col("x"), F.col("y"), ends="left").alias("left"),
        g.in_field(F.col("x"), F.col("y")).alias("field"),
        g.restart_kind(F.col("x")).alias("kind"),
    ).collect()

    def box(x, y):
        return INNER < abs(x) < HALF_L and abs(y) < AREA_W

    def left(x, y):
        return -HALF_L < x < -INNER and -AREA_W < y < AREA_W

    for r in got:
        assert r.box == box(r.x, r.y)
        assert r.left == left(r.x, r.y)
        assert r.field == (abs(r.x) < HALF_L and abs(r.y) < HALF_W)
        assert r.kind == ("corner" if abs(r.x) >= HALF_L else "throw-in")
