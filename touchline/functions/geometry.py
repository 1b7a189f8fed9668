"""Pitch geometry as native Column expressions (no Python UDF).

Positions are metres with the origin at the centre spot and x along the length.
All tests use strict bounds, so a point exactly on a line is outside. A null or
short position gives null, never an error.

Pitch size may be a number or a Column (per-match size from the metadata table).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's): default pitch size in metres, the
# yard, the penalty area (18 yd deep, 44 yd wide) and the frame period in seconds.
PITCH_LENGTH_M = 104.85
PITCH_WIDTH_M = 67.97
METRES_PER_YARD = 0.9144
PENALTY_AREA_LENGTH_M = 18 * METRES_PER_YARD
PENALTY_AREA_WIDTH_M = 44 * METRES_PER_YARD
FRAME_SECONDS = 0.04

# Restart labels and the team rule for a ball that left the field: team "A" is home.
CORNER = "corner"
THROW_IN = "throw-in"
HOME_TEAM_CODE = "A"

Number = float | Column


def _num(value: Number) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def xy(position: Column) -> tuple[Column, Column]:
    """x and y of an ``array<double>`` position; null when missing or short."""
    return F.get(position, 0), F.get(position, 1)


def in_penalty_area(
    x: Column,
    y: Column,
    length: Number = PITCH_LENGTH_M,
    ends: str = "both",
) -> Column:
    """Ball strictly inside a penalty area.

    ``ends="both"`` tests both areas. ``ends="left"`` tests only the area at
    negative x, which is what the reference's helper ends up doing.
    """
    half = _num(length) / F.lit(2.0)
    inner = half - F.lit(PENALTY_AREA_LENGTH_M)
    half_w = F.lit(PENALTY_AREA_WIDTH_M / 2.0)
    if ends == "both":
        inside = (F.abs(x) < half) & (F.abs(x) > inner) & (F.abs(y) < half_w)
    elif ends == "left":
        inside = (x > -half) & (x < -inner) & (y > -half_w) & (y < half_w)
    else:
        raise ValueError(f"ends must be 'both' or 'left', got {ends!r}")
    return _unknown_if_null(x, y, inside)


def _unknown_if_null(x: Column, y: Column, flag: Column) -> Column:
    """A missing coordinate makes the answer unknown (null), not false."""
    return F.when(x.isNull() | y.isNull(), F.lit(None).cast("boolean")).otherwise(flag)


def in_field(
    x: Column,
    y: Column,
    length: Number = PITCH_LENGTH_M,
    width: Number = PITCH_WIDTH_M,
) -> Column:
    """Ball strictly inside the touch and goal lines."""
    inside = (F.abs(x) < _num(length) / F.lit(2.0)) & (F.abs(y) < _num(width) / F.lit(2.0))
    return _unknown_if_null(x, y, inside)


def restart_kind(x: Column, length: Number = PITCH_LENGTH_M) -> Column:
    """For a ball out of play: over a goal line is a corner, else a throw-in."""
    return F.when(x.isNull(), F.lit(None)).when(
        F.abs(x) >= _num(length) / F.lit(2.0), F.lit(CORNER)
    ).otherwise(F.lit(THROW_IN))


def restart_spot(
    x: Column,
    y: Column,
    length: Number = PITCH_LENGTH_M,
    width: Number = PITCH_WIDTH_M,
) -> tuple[Column, Column]:
    """Where play restarts: the nearest corner, or the touch line at the ball's x."""
    half_l = _num(length) / F.lit(2.0)
    half_w = _num(width) / F.lit(2.0)
    corner = F.abs(x) >= half_l
    spot_x = F.when(corner, F.signum(x) * half_l).otherwise(x)
    # The touch line on the ball's side (y = 0 counts as the positive side, so a
    # ball out over the goal line mid-goal still gets a real corner).
    spot_y = F.when(y.isNull(), F.lit(None)).when(y >= 0, half_w).otherwise(-half_w)
    return spot_x, spot_y


def restart_team(ball_team: Column) -> Column:
    return F.when(ball_team.isNull(), F.lit(None)).when(
        ball_team == F.lit(HOME_TEAM_CODE), F.lit("home")
    ).otherwise(F.lit("away"))
