"""Player speed features.

The reference builds its player feature table from two plans that it then joins:
an average/maximum of the reported speed per (player, match), and a maximum of the
directional speed ``|Δx| / Δt`` per player from two ``lag`` windows. Here both come
from one pass over the rows: one hash exchange on (match, side, player, period,
clock slot), one sort, one window, then aggregation over the per-slot table
(one row per player and hour of the game clock by default). See :mod:`touchline.operators.sequence` for
why and how sequences are bucketed.

Our defaults fix the reference's defects (SURVEY §0.1): the lag restarts per match,
side and period (D13), the order is total (D11), a player's first frame has no
speed (D12) and Δt = 0 gives null instead of an error (D14). The reference's
behaviour stays available as :func:`max_speed_x_zero_fill`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.sequence import SLOT_SECONDS, time_slot, with_previous

PLAYER_KEYS = ["match_date", "side", "player_id"]
ORDER = ["game_clock", "frame_idx"]
_B = "__speed_bucket"


def speed_x(x: Column, prev_x: Column, t: Column, prev_t: Column) -> Column:
    """Directional speed along the pitch length in m/s; null when Δt is 0."""
    return F.try_divide(F.abs(x - prev_x), t - prev_t)


#: Slot of the parity sequences, which interleave all matches of a player by game clock.
PARITY_SLOT_SECONDS = 10.0


def _parity_slot(width: float) -> Column:
    """Parity sequences run across matches in (period, game clock) order."""
    return F.col("period").cast("bigint") * F.lit(10**12) + time_slot("game_clock", width)


def bucket_partials(rows: DataFrame, seq_keys: list[str], bucket: Column) -> DataFrame:
    """Per (sequence, bucket): speed sum, count and maximum, the directional-speed maximum
    inside the bucket, and where its first and last row are."""
    rows = rows.withColumn(_B, bucket)
    w = Window.partitionBy(*seq_keys, _B).orderBy(*ORDER)
    rows = rows.withColumn(
        "__sx", speed_x(F.col("x"), F.lag("x").over(w), F.col("game_clock"), F.lag("game_clock").over(w))
    )
    order_key = F.struct(*ORDER)
    pos = F.struct("x", "game_clock")
    return rows.groupBy(*seq_keys, _B).agg(
        F.sum("speed").alias("speed_sum"),
        F.count("speed").alias("speed_n"),
        F.max("speed").alias("speed_max"),
        F.max("__sx").alias("inner_speed_x"),
        F.min_by(pos, order_key).alias("head"),
        F.max_by(pos, order_key).alias("tail"),
    ).select(
        *seq_keys, _B, "speed_sum", "speed_n", "speed_max", "inner_speed_x",
        F.col("head.x").alias("head_x"), F.col("head.game_clock").alias("head_t"),
        F.col("tail.x").alias("tail_x"), F.col("tail.game_clock").alias("tail_t"),
    )


def _bucket_table(rows: DataFrame, seq_keys: list[str], bucket: Column, first_frame: str) -> DataFrame:
    return with_edges(bucket_partials(rows, seq_keys, bucket), seq_keys, first_frame)


def with_edges(per_bucket: DataFrame, seq_keys: list[str], first_frame: str = "skip") -> DataFrame:
    """``edge_speed_x`` is the speed of the bucket's first row against the last row of
    the bucket before (a window per sequence over this one-row-per-bucket table);
    with ``first_frame="zero"`` a sequence's very first row is compared with position 0
    at time 0, as the reference's ``fillna(0.0)`` does.
    """
    per_bucket = with_previous(per_bucket, seq_keys, [_B], None, ["tail_x", "tail_t"])
    prev_x, prev_t = F.col("prev_tail_x"), F.col("prev_tail_t")
    if first_frame == "zero":
        prev_x, prev_t = F.coalesce(prev_x, F.lit(0.0)), F.coalesce(prev_t, F.lit(0.0))
    elif first_frame != "skip":
        raise ValueError(f"first_frame must be 'skip' or 'zero', got {first_frame!r}")
    return per_bucket.withColumn("edge_speed_x", speed_x(F.col("head_x"), prev_x, F.col("head_t"), prev_t))


def player_features(tracking_df: DataFrame, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Per (match, side, player): average and maximum speed, maximum x-speed.

    Rows without a game clock count for the speeds but have no place in the order, so
    they have no x-speed. ``slot_seconds`` sets the size of a sorted group only.
    """
    rows = tracking_df.select(*PLAYER_KEYS, "period", *ORDER, "x", "speed")
    timed = rows.where(F.col("game_clock").isNotNull())
    buckets = _bucket_table(timed, PLAYER_KEYS + ["period"], time_slot("game_clock", slot_seconds), "skip")
    untimed = rows.where(F.col("game_clock").isNull()).groupBy(*PLAYER_KEYS).agg(
        F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_n"), F.max("speed").alias("speed_max"))
    return merge_buckets(buckets.unionByName(untimed, allowMissingColumns=True))


def merge_buckets(buckets: DataFrame) -> DataFrame:
    """The features of each player from buckets with edges (:func:`with_edges`)."""
    return buckets.groupBy(*PLAYER_KEYS).agg(
        F.round(F.try_divide(F.sum("speed_sum"), F.sum("speed_n")), 6).alias("player_avg_speed"),
        F.max("speed_max").alias("player_max_speed"),
        F.greatest(F.max("inner_speed_x"), F.max("edge_speed_x")).alias("maximum_speed_x"),
    )


def player_speed_stats(tracking_df: DataFrame) -> DataFrame:
    """Average and maximum reported speed per (match, side, player)."""
    return tracking_df.groupBy(*PLAYER_KEYS).agg(
        F.round(F.avg("speed"), 6).alias("player_avg_speed"),
        F.max("speed").alias("player_max_speed"),
    )


def max_speed_x(tracking_df: DataFrame) -> DataFrame:
    return player_features(tracking_df).select(*PLAYER_KEYS, "maximum_speed_x")


def max_speed_x_zero_fill(tracking_df: DataFrame, slot_seconds: float = PARITY_SLOT_SECONDS) -> DataFrame:
    """Reference parity: one sequence per (side, player) across matches and periods,
    ordered by (period, game clock). Every null is 0 before the speed is taken: a
    row's position and clock, and the lags of the first row."""
    keys = ["side", "player_id"]
    rows = tracking_df.select(*keys, "period", *ORDER, "x", "speed").fillna(0.0, subset=["x", "game_clock"])
    rows = rows.fillna(0, subset=["period"])
    buckets = _bucket_table(rows, keys, _parity_slot(slot_seconds), "zero")
    return buckets.groupBy(*keys).agg(
        F.greatest(F.max("inner_speed_x"), F.max("edge_speed_x")).alias("maximum_speed_x")
    )


def frame_speed_x(tracking_df: DataFrame, slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Directional speed of every frame that has a previous frame of the same player."""
    seq = PLAYER_KEYS + ["period"]
    rows = tracking_df.select(*seq, *ORDER, "x").where(F.col("game_clock").isNotNull())
    rows = with_previous(rows, seq, ORDER, time_slot("game_clock", slot_seconds), ["x", "game_clock"])
    return rows.where(F.col("prev_game_clock").isNotNull()).select(
        *seq,
        "frame_idx",
        "game_clock",
        speed_x(F.col("x"), F.col("prev_x"), F.col("game_clock"), F.col("prev_game_clock")).alias("speed_x"),
    )


def player_performance(tracking_df: DataFrame) -> DataFrame:
    """The player feature table (both sides), single-pass form."""
    return player_features(tracking_df)


def player_performance_join(tracking_df: DataFrame) -> DataFrame:
    """The reference's form: speed stats left-joined with the x-speed maxima.

    Kept to check the single-pass form against; costs a second scan and a join.
    """
    stats = player_speed_stats(tracking_df)
    return stats.join(max_speed_x(tracking_df), on=PLAYER_KEYS, how="left")
