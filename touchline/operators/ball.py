"""Ball features: time in the penalty area, field flags, latest and sampled state.

All flags are native expressions (:mod:`touchline.functions.geometry`), so the
area filter is pushed below the aggregate and, on stored tables, to the scan.
Aggregates are plain ``groupBy`` with map-side partial aggregation: a match with
a third of all rows contributes one partial row per task to the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.geometry import (
    FRAME_SECONDS,
    PITCH_LENGTH_M,
    PITCH_WIDTH_M,
    in_field,
    in_penalty_area,
)
from touchline.operators.joins import join_lookup

STATE_COLUMNS = ["wall_ms", "frame_idx", "ball_status", "x", "y", "ball_team", "in_box", "in_field"]
SAMPLE_MS = 3000


def ball_flags(
    ball_df: DataFrame,
    length=PITCH_LENGTH_M,
    width=PITCH_WIDTH_M,
    ends: str = "both",
) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    return ball_df.withColumn("in_box", in_penalty_area(x, y, length, ends)).withColumn(
        "in_field", in_field(x, y, length, width)
    )


def box_minutes(flagged: DataFrame, keys: list[str]) -> DataFrame:
    """Minutes (25 Hz frames) and frame count of the given (already filtered) rows."""
    n = F.count(F.lit(1))
    return flagged.groupBy(*keys).agg(
        F.lit(True).alias("ball_inside_box"),
        (n * F.lit(FRAME_SECONDS) / F.lit(60.0)).alias("minutes_inside_box"),
        n.alias("n_times_inside_box"),
    )


def ball_in_box_stats(ball_df: DataFrame, ends: str = "both", length=PITCH_LENGTH_M) -> DataFrame:
    """Per match: minutes (25 Hz frames) and frame count with the ball in an area.

    ``n_times_inside_box`` counts frames, as in the reference, not visits.
    """
    inside = ball_df.where(in_penalty_area(F.col("x"), F.col("y"), length, ends))
    return box_minutes(inside, ["match_id"])


def ball_in_box_by_pitch(ball_df: DataFrame, metadata: DataFrame, ends: str = "both") -> DataFrame:
    """Same as :func:`ball_in_box_stats`, with each match's own pitch length.

    ``metadata`` has one row per match (``match_id``, ``pitch_length``, ``pitch_width``).
    Matches without metadata, or without a length in it, have the default pitch.
    """
    joined = join_lookup(ball_df, metadata.select("match_id", "pitch_length"), ["match_id"], how="left")
    joined = joined.fillna({"pitch_length": PITCH_LENGTH_M})
    inside = joined.where(in_penalty_area(F.col("x"), F.col("y"), F.col("pitch_length"), ends))
    return box_minutes(inside, ["match_id", "pitch_length"])


def ball_in_field(ball_df: DataFrame) -> DataFrame:
    """Every ball row with its area and field flags."""
    return ball_flags(ball_df).select("match_id", "wall_ms", "frame_idx", "x", "y", "in_box", "in_field")


def latest_ball_state(flagged: DataFrame) -> DataFrame:
    """Newest ball row per match by (wall clock, frame).

    Three hash aggregates instead of one over structs, which would sort all rows: the
    largest clock of a match, its largest frame, and one of the rows that have both.
    Only the candidates (rows at a match's last clock) are joined back; the join key
    holds the clock, so a hot match is not one task's. Rows without a clock count as
    oldest: a match of only such rows has no newest row.
    """
    rows = flagged.where(F.col("wall_ms").isNotNull()).select("match_id", *STATE_COLUMNS)
    clock = rows.groupBy("match_id").agg(F.max("wall_ms").alias("_ms")).withColumnRenamed("match_id", "_m")
    last = rows.join(clock, F.col("match_id").eqNullSafe(F.col("_m")) & (F.col("wall_ms") == F.col("_ms"))).drop("_m", "_ms")
    newest = F.max_by(F.struct(*STATE_COLUMNS), F.struct("frame_idx", "ball_status", "x", "y"))
    return last.groupBy("match_id").agg(newest.alias("s")).select(
        "match_id", *[F.col(f"s.{c}").alias(c) for c in STATE_COLUMNS]
    )


def sampled_ball_state(flagged: DataFrame, every_ms: int = SAMPLE_MS) -> DataFrame:
    """Newest ball row per match in each ``every_ms`` tumbling window of the clock.

    The batch form of the reference's poll-every-3-seconds loop: what a poller
    would have seen, without its misses.
    """
    start = F.col("wall_ms") - F.pmod(F.col("wall_ms"), F.lit(every_ms).cast("bigint"))
    newest = F.max_by(F.struct(*STATE_COLUMNS), F.struct("wall_ms", "frame_idx"))
    return (
        flagged.withColumn("window_start_ms", start)
        .groupBy("match_id", "window_start_ms")
        .agg(newest.alias("s"))
        .select("match_id", "window_start_ms", *[F.col(f"s.{c}").alias(c) for c in STATE_COLUMNS])
    )
