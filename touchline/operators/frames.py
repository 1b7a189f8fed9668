"""Nested frame records → flat player and ball tables, dedup, quality gate.

The reference explodes ``homePlayers`` and then ``awayPlayers`` in one select,
which makes every home × away pair per frame (121 rows for 11 a side) and drops
a frame's players when either list is empty; it then de-duplicates. Here the two
lists are tagged with their side, concatenated and exploded once: one row per
player per frame, one scan, no pairs. The reference's de-duplicated result stays
available as :func:`dedup_players` without ever building the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions.clock import match_date
from touchline.functions.geometry import PITCH_LENGTH_M, in_penalty_area


def match_key(frames: DataFrame) -> Column:
    """The match of a frame: its ``matchId`` where the input names one, else its UTC day.

    Two matches of a day, or a match over midnight, need the id (from the feed, the
    metadata element or the file name); the day is all there is without it."""
    day = match_date(F.col("wallClock"))
    return F.coalesce(F.col("matchId"), day) if "matchId" in frames.columns else day


def _frame_keys(frames: DataFrame) -> list[Column]:
    return [
        match_key(frames).alias("match_date"),
        F.col("period"),
        F.col("frameIdx").alias("frame_idx"),
        F.col("gameClock").alias("game_clock"),
        F.col("wallClock").alias("wall_ms"),
        F.col("live"),
        F.col("lastTouch").alias("last_touch"),
    ]


def _tagged(list_col: str, side: str) -> Column:
    empty = F.array().cast(schemas.FRAME["homePlayers"].dataType)
    return F.transform(
        F.coalesce(F.col(list_col), empty),
        lambda p: F.struct(
            F.lit(side).alias("side"),
            p["playerId"].alias("player_id"),
            p["speed"].alias("speed"),
            F.get(p["xyz"], 0).alias("x"),
            F.get(p["xyz"], 1).alias("y"),
            F.get(p["xyz"], 2).alias("z"),
        ),
    )


def unified_players(frames: DataFrame) -> DataFrame:
    """One row per player per frame (FIXTURES.md F4), both sides, one explode."""
    both = F.concat(_tagged("homePlayers", "home"), _tagged("awayPlayers", "away"))
    return frames.select(*_frame_keys(frames), F.inline(both))


def unified_ball(frames: DataFrame, length=PITCH_LENGTH_M, ends: str = "both") -> DataFrame:
    """One ball row per frame with its penalty-area flag (FIXTURES.md F5)."""
    x, y = F.get(F.col("ball.xyz"), 0), F.get(F.col("ball.xyz"), 1)
    return frames.select(
        match_key(frames).alias("match_id"),
        F.col("wallClock").alias("wall_ms"),
        F.col("frameIdx").alias("frame_idx"),
        "period",
        F.col("gameClock").alias("game_clock"),
        "live",
        x.alias("x"),
        y.alias("y"),
        F.get(F.col("ball.xyz"), 2).alias("z"),
        F.col("ball.speed").alias("ball_speed"),
        in_penalty_area(x, y, length, ends).alias("ball_inside_box"),
    )


def split_by_side(players: DataFrame, side: str) -> DataFrame:
    """One team's rows. The reference selects ``home*``/``away*`` columns by name
    prefix from its wide pair rows; the flat table has a ``side`` column instead."""
    return players.where(F.col("side") == F.lit(side))


def dedup_players(frames: DataFrame) -> DataFrame:
    """Reference parity for its pair rows: distinct player rows of frames in which
    both teams have players. Map-side partial aggregation collapses copies before
    the shuffle."""
    both_sides = frames.where((F.size("homePlayers") > 0) & (F.size("awayPlayers") > 0))
    return unified_players(both_sides).dropDuplicates()


def dedup_frames(frames: DataFrame) -> DataFrame:
    """Drop repeated input lines once, at frame level, before any explode.

    Two lines are the same delivery when match, clocks, frame, period and content (a
    hash) agree; different frames under one key both stay. Rows are grouped by that
    narrow key, one number per frame, so nested arrays are never compared."""
    content = F.xxhash64(*[F.col(c) for c in frames.columns if c in schemas.FRAME_WITH_CORRUPT.fieldNames()])
    keyed = frames.withColumn("__match", match_key(frames)).withColumn("__content", content)
    return keyed.dropDuplicates(["__match", "wallClock", "frameIdx", "period", "__content"]).drop("__match", "__content")


# -- quality gate -------------------------------------------------------------------

def _bad_players(list_col: str) -> Column:
    return F.coalesce(
        F.exists(F.col(list_col), lambda p: p["playerId"].isNull() | (F.coalesce(F.size(p["xyz"]), F.lit(0)) < 3)),
        F.lit(False),
    )


#: Halves, extra-time halves and the shoot-out.
PERIODS = (1, 2, 3, 4, 5)


def quality_flags(frames: DataFrame) -> DataFrame:
    """Add one boolean column per rule. ``frames`` should come from
    :func:`touchline.sources.files.read_frames` with ``keep_corrupt=True``."""
    corrupt = F.col(schemas.CORRUPT).isNotNull() if schemas.CORRUPT in frames.columns else F.lit(False)
    return frames.select(
        "*",
        corrupt.alias("q_corrupt"),
        # A clock out of range has no day, so it counts as missing.
        (match_date(F.col("wallClock")).isNull() | F.col("gameClock").isNull()).alias("q_missing_clock"),
        F.coalesce(~F.col("period").isin(*PERIODS), F.lit(True)).alias("q_bad_period"),
        (F.coalesce(F.size(F.col("ball.xyz")), F.lit(0)) < 3).alias("q_short_ball_xyz"),
        (_bad_players("homePlayers") | _bad_players("awayPlayers")).alias("q_bad_player"),
        (F.coalesce(F.size("homePlayers"), F.lit(0)) == 0).alias("q_no_home"),
        (F.coalesce(F.size("awayPlayers"), F.lit(0)) == 0).alias("q_no_away"),
    )


BLOCKING = ["q_corrupt", "q_missing_clock", "q_bad_period", "q_short_ball_xyz", "q_bad_player"]
RULES = BLOCKING + ["q_no_home", "q_no_away"]


def quality_split(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted frames, quarantined frames with their failed rules).

    The strict gate: a bad player or ball blocks its whole frame. :func:`quality_rows`
    keeps the rest of such a frame."""
    return split_flagged(quality_flags(frames))


def split_flagged(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`quality_split` on frames that already carry the rule columns."""
    bad = F.lit(False)
    for rule in BLOCKING:
        bad = bad | F.col(rule)
    reasons = F.filter(
        F.array(*[F.when(F.col(r), F.lit(r[2:])) for r in BLOCKING]), lambda r: r.isNotNull()
    )
    good = flagged.where(~bad).drop(*RULES)
    quarantined = flagged.where(bad).withColumn("reasons", reasons).drop(*RULES)
    return good, quarantined


#: Rules that leave nothing of a frame to store.
FRAME_RULES = ["q_corrupt", "q_missing_clock", "q_bad_period"]
REJECT_COLUMNS = ["match_date", "period", "frame_idx", "part", "side", "player_id", "reasons"]


def quality_rows(flagged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Row-level gate on frames with rule columns: (player rows, ball rows, rejects).

    A frame without a usable clock or period, or an unreadable line, is one reject; a
    player without an id or position and a ball without a position are a reject each,
    and the frame's other rows stay. Every input row is in exactly one of the three.
    """
    bad = F.lit(False)
    for rule in FRAME_RULES:
        bad = bad | F.col(rule)
    good = flagged.where(~bad)
    none = F.lit(None).cast("string")

    def reasons(*found: Column) -> Column:
        return F.filter(F.array(*found), lambda r: r.isNotNull()).alias("reasons")

    frame_rejects = flagged.where(bad).select(
        match_key(flagged).alias("match_date"), "period", F.col("frameIdx").alias("frame_idx"),
        F.lit("frame").alias("part"), none.alias("side"), none.alias("player_id"),
        reasons(*[F.when(F.col(r), F.lit(r[2:])) for r in FRAME_RULES]))
    players = unified_players(good)
    no_id, no_place = F.col("player_id").isNull(), F.col("x").isNull() | F.col("y").isNull()
    player_rejects = players.where(no_id | no_place).select(
        "match_date", "period", "frame_idx", F.lit("player").alias("part"), "side", "player_id",
        reasons(F.when(no_id, F.lit("no_player_id")), F.when(no_place, F.lit("no_position"))))
    ball_rows = unified_ball(good)
    ball_rejects = ball_rows.where(no_place).select(
        F.col("match_id").alias("match_date"), "period", "frame_idx", F.lit("ball").alias("part"), none.alias("side"),
        none.alias("player_id"), reasons(F.lit("no_position")))
    rejects = frame_rejects.unionByName(player_rejects).unionByName(ball_rejects)
    return players.where(~no_id & ~no_place), ball_rows.where(~no_place), rejects


def frame_quality_report(frames: DataFrame) -> DataFrame:
    """Per match: frames read and how many break each rule."""
    flagged = quality_flags(frames)
    counts = [F.count(F.when(F.col(r), 1)).alias("n_" + r[2:]) for r in RULES]
    return flagged.groupBy(match_key(flagged).alias("match_id")).agg(
        F.count(F.lit(1)).alias("n_frames"), *counts
    )
