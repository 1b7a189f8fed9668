"""Feed line records → typed ball rows (used by the stream and in batch).

A line is ``<wallClock ms>:<players>:<x cm>,<y cm>,<z cm>,<speed>,<team>,<status>;:``.
Every field is parsed with ``try_cast``: a bad number becomes null instead of
failing the query (ANSI casts raise). Rows without a clock have no place in the feed
and are routed to quarantine by :func:`split_parsed`; rows without a position keep
their status, with null flags.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.clock import MAX_ABS_MS, display_time, match_date
from touchline.functions.geometry import in_field, in_penalty_area


def parse_ball_lines(lines: DataFrame, value_col: str = "value", match_id=None) -> DataFrame:
    """Typed ball rows. ``match_id`` is a column of ``lines`` that names the match (for
    example from the input file's name); without it the match is the clock's UTC day."""
    parts = F.split(F.col(value_col), ":")
    wall_ms = F.get(parts, 0).try_cast("bigint")
    # A clock beyond +-10^15 ms (year 33,000) is a bad number, not a time.
    wall_ms = F.when(F.abs(wall_ms) < F.lit(MAX_ABS_MS), wall_ms)
    players = F.get(parts, 1)
    ball_raw = F.get(parts, 2)
    fields = F.split(ball_raw, ",")
    metres = lambda i: F.get(fields, i).try_cast("double") / F.lit(100.0)
    x, y, z = metres(0), metres(1), metres(2)
    rows = lines.select(
        (match_id if match_id is not None else F.lit(None).cast("string")).alias("named_match"),
        wall_ms.alias("wall_ms"),
        # The players block is opaque; an optional "F<n>" prefix is the frame index.
        F.regexp_extract(players, r"^F(\d+)", 1).try_cast("bigint").alias("frame_idx"),
        ball_raw.alias("ball_raw"),
        x.alias("x"),
        y.alias("y"),
        z.alias("z"),
        F.regexp_replace(F.get(fields, 5), ";", "").alias("ball_status"),
        F.get(fields, 3).try_cast("double").alias("ball_speed"),
        F.get(fields, 4).alias("ball_team"),
    )
    return rows.select(
        F.coalesce(F.col("named_match"), match_date(F.col("wall_ms"))).alias("match_id"),
        display_time(F.col("wall_ms")).alias("match_time"),
        "wall_ms",
        "frame_idx",
        "ball_raw",
        F.array("x", "y", "z").alias("ball_position"),
        "x", "y", "z",
        "ball_status",
        "ball_speed",
        "ball_team",
        in_penalty_area(F.col("x"), F.col("y")).alias("in_box"),
        in_field(F.col("x"), F.col("y")).alias("in_field"),
    )


def split_parsed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, quarantined rows): a row needs a clock. A missing position makes
    the flags null, and a null flag yields no event; the line's status still counts."""
    ok = F.col("wall_ms").isNotNull()
    return rows.where(ok), rows.where(~ok)
