"""Map the driver's ``events`` table onto tracking data.

Each ``events`` row becomes one tracking row: a player position and the ball's
state at that instant. The same mapping is written in SQL in
:mod:`touchline.plans.oracle`, so the two engines see identical inputs.

From the flat rows Spark derives the reference's other input shapes: nested
frame records (JSON lines), match metadata (XML) and stream line records (text).
All of these are narrow projections or bounded groupings; nothing here shuffles a
whole match into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.geometry import HOME_TEAM_CODE

# Players of at most this many consecutive events share one nested frame, so a
# frame's player lists are bounded by construction (event ids are unique).
EVENTS_PER_FRAME = 16

HALF_DAY_MS = 43_200_000


def load(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{sf_dir.rstrip('/')}/{name}.{fmt}")


def _wall_ms() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def tracking_rows(events: DataFrame) -> DataFrame:
    """``events`` → one row per player per instant (FIXTURES.md adapter)."""
    wall_ms = _wall_ms()
    return events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("match_date"),
        wall_ms.alias("wall_ms"),
        F.when(F.hour("ts") < 12, F.lit(1)).otherwise(F.lit(2)).alias("period"),
        F.col("event_id").alias("frame_idx"),
        F.when(F.col("user_id") % 2 == 0, F.lit("home")).otherwise(F.lit("away")).alias("side"),
        F.concat(F.lit("p"), F.col("user_id").cast("string")).alias("player_id"),
        F.col("value").alias("speed"),
        ((F.col("event_id") * 7919) % 1160 / F.lit(10.0) - F.lit(58.0)).alias("x"),
        ((F.col("event_id") * 104729) % 760 / F.lit(10.0) - F.lit(38.0)).alias("y"),
        F.when(F.col("event_type") == "error", F.lit("Dead")).otherwise(F.lit("Alive")).alias("ball_status"),
        ((wall_ms % HALF_DAY_MS) / F.lit(1000.0)).alias("game_clock"),
    )


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking_rows(load(spark, sf_dir, "events"))


def ball_rows(tracking_df: DataFrame) -> DataFrame:
    """The ball table of the adapter: one ball state per tracking row.

    ``match_id`` is the match day; ``ball_team`` uses the feed's codes (``A`` home).
    """
    return tracking_df.select(
        F.col("match_date").alias("match_id"),
        "wall_ms",
        "frame_idx",
        "period",
        "game_clock",
        "ball_status",
        "x",
        "y",
        F.lit(0.0).alias("z"),
        F.col("speed").alias("ball_speed"),
        F.when(F.col("side") == "home", F.lit(HOME_TEAM_CODE)).otherwise(F.lit("B")).alias("ball_team"),
    )


def nested_frames(tracking_df: DataFrame) -> DataFrame:
    """Tracking rows → reference-shaped frame records (FIXTURES.md F1).

    A frame holds the players of up to ``EVENTS_PER_FRAME`` consecutive events of
    one match half; its clocks are the earliest in the group and its ball is the
    first event's. Grouping is a bounded ``collect_list`` with map-side partial
    aggregation.
    """
    player = F.struct(
        F.col("player_id").alias("playerId"),
        F.col("speed").alias("speed"),
        F.array(F.col("x"), F.col("y"), F.lit(0.0)).alias("xyz"),
    )
    first = F.struct("frame_idx", "x", "y", "speed", "ball_status", "side")
    grouped = (
        tracking_df.withColumn("frame_no", F.expr(f"frame_idx div {EVENTS_PER_FRAME}"))
        .groupBy("match_date", "period", "frame_no")
        .agg(
            F.min("game_clock").alias("gameClock"),
            F.min("wall_ms").alias("wallClock"),
            F.min_by(first, F.col("frame_idx")).alias("first"),
            F.collect_list(F.when(F.col("side") == "home", player)).alias("homePlayers"),
            F.collect_list(F.when(F.col("side") == "away", player)).alias("awayPlayers"),
        )
    )
    return grouped.select(
        F.col("period").cast("int").alias("period"),
        F.col("frame_no").cast("bigint").alias("frameIdx"),
        "gameClock",
        "wallClock",
        (F.col("first.ball_status") == "Alive").alias("live"),
        F.col("first.side").alias("lastTouch"),
        "homePlayers",
        "awayPlayers",
        F.struct(
            F.array(F.col("first.x"), F.col("first.y"), F.lit(0.0)).alias("xyz"),
            F.col("first.speed").alias("speed"),
        ).alias("ball"),
    )


def stream_lines(tracking_df: DataFrame) -> DataFrame:
    """Tracking rows → feed lines ``<wallClock>:<players>:<x>,<y>,<z>,<speed>,<team>,<status>;:``.

    Positions are whole centimetres. The players block is opaque to the ball
    parser; it starts with ``F<frame_idx>`` so the stream keeps a total order.
    """
    cm = lambda c: F.round(F.col(c) * F.lit(100.0)).cast("bigint").cast("string")
    team = F.when(F.col("side") == "home", F.lit(HOME_TEAM_CODE)).otherwise(F.lit("B"))
    value = F.concat(
        F.col("wall_ms").cast("string"), F.lit(":"),
        F.lit("F"), F.col("frame_idx").cast("string"), F.lit("|"), F.col("player_id"), F.lit(":"),
        cm("x"), F.lit(","), cm("y"), F.lit(",0,"),
        F.col("speed").cast("string"), F.lit(","), team, F.lit(","), F.col("ball_status"), F.lit(";:"),
    )
    return tracking_df.select(value.alias("value"))


def match_metadata(tracking_df: DataFrame) -> DataFrame:
    """One metadata row per match: kickoff text and a pitch size.

    The driver's tables carry no pitch sizes, so each match day gets a size from
    a fixed rule of its day of month (length 100-105 m, width 64-68 m).
    """
    day = F.dayofmonth(F.to_date("match_date"))
    return tracking_df.groupBy("match_date").agg(
        F.date_format(F.timestamp_millis(F.min("wall_ms")), "yyyy-MM-dd HH:mm:ss").alias("dtDate"),
    ).select(
        "match_date",
        "dtDate",
        (F.lit(100.0) + (day % 6).cast("double")).alias("fPitchXSizeMeters"),
        (F.lit(64.0) + (day % 5).cast("double")).alias("fPitchYSizeMeters"),
    )


# -- inputs with faults, for the queries that must cope with them -------------------------

def with_gaps(tracking_df: DataFrame) -> DataFrame:
    """Tracking rows without a position (every 11th) or a game clock (every 13th)."""
    return tracking_df.withColumn("x", F.when(F.col("frame_idx") % 11 != 0, F.col("x"))).withColumn(
        "game_clock", F.when(F.col("frame_idx") % 13 != 0, F.col("game_clock")))


def two_matches_a_day(nested: DataFrame) -> DataFrame:
    """Every day's frames as two matches, ``<day>-A`` and ``<day>-B``; B is played in
    extra time (periods 3 and 4) at the same clocks and frame numbers."""
    day = F.date_format(F.timestamp_millis("wallClock"), "yyyy-MM-dd")
    a = nested.withColumn("matchId", F.concat(day, F.lit("-A")))
    b = nested.withColumn("matchId", F.concat(day, F.lit("-B"))).withColumn("period", (F.col("period") + 2).cast("int"))
    return a.unionByName(b)


def with_faults(nested: DataFrame) -> DataFrame:
    """Frames with faults by frame number: an unknown period (every 50th), no game clock
    (every 60th), a ball without a place (every 7th), a first home player without an id
    (every 9th)."""
    no = F.col("frameIdx")
    player = nested.schema["homePlayers"].dataType.elementType
    nameless = F.transform("homePlayers", lambda p, i: F.when(i > 0, p).otherwise(p.withField("playerId", F.lit(None).cast("string"))))
    return nested.select(
        *[c for c in nested.columns if c not in ("period", "gameClock", "ball", "homePlayers")],
        F.when(no % 50 == 0, F.lit(9)).otherwise(F.col("period")).cast("int").alias("period"),
        F.when(no % 60 != 0, F.col("gameClock")).alias("gameClock"),
        F.when(no % 7 != 0, F.col("ball")).otherwise(F.col("ball").withField("xyz", F.slice("ball.xyz", 1, 1))).alias("ball"),
        F.when(no % 9 == 0, nameless).otherwise(F.col("homePlayers")).cast(f"array<{player.simpleString()}>").alias("homePlayers"),
    )


def drifted_lines(nested: DataFrame) -> DataFrame:
    """Frames as JSON lines (``value``) of a feed that changed, by frame number: no last touch
    (every 3rd), home players without a speed (4th), a new field (5th), the game clock as
    text (7th), a line cut off (13th)."""
    no = F.col("frameIdx")
    slow = F.transform("homePlayers", lambda p: p.withField("speed", F.lit(None).cast("double")))
    record = F.to_json(F.struct(*[
        F.when(no % 3 != 0, F.col(c)).alias(c) if c == "lastTouch" else F.when(no % 4 == 0, slow).otherwise(F.col(c)).alias(c) if c == "homePlayers" else F.col(c)
        for c in nested.columns]))
    record = F.when(no % 5 == 0, F.regexp_replace(record, "^[{]", '{"weather":"rain",')).otherwise(record)
    record = F.when(no % 7 == 0, F.regexp_replace(record, '"gameClock":([0-9.E+-]+)', '"gameClock":"$1"')).otherwise(record)
    return nested.select(F.when(no % 13 == 0, F.substring(record, 1, 20)).otherwise(record).alias("value"))


def broken_lines(nested: DataFrame) -> DataFrame:
    """Unreadable input lines (every 40th frame sends one): JSON cut in its middle."""
    cut = F.concat(F.lit('{"period": 1, "frameIdx": '), F.col("frameIdx").cast("string"), F.lit(', "gameClock": "oops'))
    return nested.where(F.col("frameIdx") % 40 == 0).select(cut.alias("value"))
