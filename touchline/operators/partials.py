"""Mergeable partial features: what a player's feature row is made of, per time slot.

A stored partial holds the speed sum, count and maximum of one (match, side, player,
period, slot), the largest directional speed between its rows, and its first and last
position. Features are merged from them without the tracking rows: sums and maxima add up,
and the speed from one slot to the next follows from a tail and the next head. A late file
changes the partials of the slots it has rows in; only those slots' rows are read again.
The result equals a rebuild, whatever the slot width.

Rows without a game clock have a slot of their own (null): they count for the speeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators import speed
from touchline.operators.sequence import time_slot

#: Width of a stored slot: 25 frames a second make 7,500 rows of one player.
SLOT_SECONDS = 300.0
SLOT_KEYS = ["match_date", "side", "player_id", "period", "slot"]
_MEASURES = ["speed_sum", "speed_max", "inner_speed_x", "head_x", "head_t", "tail_x", "tail_t"]
SCHEMA = T.StructType([
    T.StructField("side", T.StringType()), T.StructField("player_id", T.StringType()), T.StructField("period", T.IntegerType()),
    T.StructField("slot", T.LongType()), T.StructField("speed_n", T.LongType()),
    *[T.StructField(c, T.DoubleType()) for c in _MEASURES],
    T.StructField("match_date", T.StringType()),
])


def with_slot(rows: DataFrame) -> DataFrame:
    return rows.withColumn("slot", time_slot("game_clock", SLOT_SECONDS))


def touched_slots(rows: DataFrame) -> DataFrame:
    """The distinct slots that ``rows`` fall in."""
    return with_slot(rows).select(*SLOT_KEYS).distinct()


def slot_partials(rows: DataFrame) -> DataFrame:
    """The partials (columns of ``SCHEMA``) of tracking rows."""
    seq = [*speed.PLAYER_KEYS, "period"]
    rows = rows.select(*seq, *speed.ORDER, "x", "speed")
    timed = speed.bucket_partials(rows.where(F.col("game_clock").isNotNull()), seq, time_slot("game_clock", SLOT_SECONDS))
    timed = timed.withColumnRenamed(speed._B, "slot")
    untimed = rows.where(F.col("game_clock").isNull()).groupBy(*seq).agg(
        F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_n"), F.max("speed").alias("speed_max"))
    both = timed.unionByName(untimed, allowMissingColumns=True)
    return both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])


def features(partials: DataFrame) -> DataFrame:
    """The player feature table from stored partials: windows and sums over one row a slot."""
    seq = [*speed.PLAYER_KEYS, "period"]
    timed = partials.where(F.col("slot").isNotNull()).withColumnRenamed("slot", speed._B)
    untimed = partials.where(F.col("slot").isNull()).drop("slot")
    return speed.merge_buckets(speed.with_edges(timed, seq).unionByName(untimed, allowMissingColumns=True))
