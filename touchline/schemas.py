"""Explicit schemas for every input shape (no inference on read)."""

from __future__ import annotations

from pyspark.sql import types as T

XYZ = T.ArrayType(T.DoubleType())

PLAYER = T.StructType([
    T.StructField("playerId", T.StringType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("xyz", XYZ),
])

# One JSON object per line: a tracking frame (FIXTURES.md F1).
FRAME = T.StructType([
    T.StructField("period", T.IntegerType()),
    T.StructField("frameIdx", T.LongType()),
    T.StructField("gameClock", T.DoubleType()),
    T.StructField("wallClock", T.LongType()),
    T.StructField("live", T.BooleanType()),
    T.StructField("lastTouch", T.StringType()),
    T.StructField("homePlayers", T.ArrayType(PLAYER)),
    T.StructField("awayPlayers", T.ArrayType(PLAYER)),
    T.StructField("ball", T.StructType([
        T.StructField("xyz", XYZ),
        T.StructField("speed", T.DoubleType()),
    ])),
])

# The same with the match's own id, for feeds that carry one (null: the day is used).
FRAME_WITH_ID = T.StructType([T.StructField("matchId", T.StringType()), *FRAME.fields])

CORRUPT = "_corrupt_record"
FRAME_WITH_CORRUPT = T.StructType(FRAME_WITH_ID.fields + [T.StructField(CORRUPT, T.StringType())])

# XML element <match dtDate=".." fPitchXSizeMeters=".." fPitchYSizeMeters=".."/>.
MATCH_METADATA = T.StructType([
    T.StructField("_dtDate", T.StringType()),
    T.StructField("_fPitchXSizeMeters", T.DoubleType()),
    T.StructField("_fPitchYSizeMeters", T.DoubleType()),
    T.StructField("_matchId", T.StringType()),
])

# Stored tracking rows (partitioned by match_date, kept as text).
TRACKING = T.StructType([
    T.StructField("wall_ms", T.LongType()),
    T.StructField("period", T.IntegerType()),
    T.StructField("frame_idx", T.LongType()),
    T.StructField("side", T.StringType()),
    T.StructField("player_id", T.StringType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("ball_status", T.StringType()),
    T.StructField("game_clock", T.DoubleType()),
    T.StructField("match_date", T.StringType()),
])

PLAYER_FEATURES = T.StructType([
    T.StructField("side", T.StringType()),
    T.StructField("player_id", T.StringType()),
    T.StructField("player_avg_speed", T.DoubleType()),
    T.StructField("player_max_speed", T.DoubleType()),
    T.StructField("maximum_speed_x", T.DoubleType()),
    T.StructField("match_date", T.StringType()),
])
