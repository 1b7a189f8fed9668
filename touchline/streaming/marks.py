"""End marks: feed lines that say a feed is over.

Event-time operators hold rows until the watermark (newest clock less the delay) has
passed them. A finished feed has no newer clock, so its tail would stay held. An end
mark is an ordinary line with a clock after the tail and the status ``END_OF_FEED``: it
moves the watermark and is no ball row itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END_STATUS = "END_OF_FEED"
#: How far after the last row a mark's clock is: beyond any delay or window in use.
MARK_AHEAD_MS = 3_600_000


def is_end_mark(status: Column) -> Column:
    return F.coalesce(status == F.lit(END_STATUS), F.lit(False))


def without_end_marks(rows: DataFrame) -> DataFrame:
    """Drop end marks after the watermark has seen them.

    The optimizer moves a condition below the watermark operator unless it needs
    ``event_time``, and it splits conjunctions first. So this is one comparison of
    ``event_time`` with a bound that no clock reaches, or that every clock exceeds."""
    bound = F.when(is_end_mark(F.col("ball_status")), F.lit(-(2**62))).otherwise(F.lit(2**62))
    return rows.where(F.unix_millis("event_time") < bound)


def end_mark_lines(feed: DataFrame, ahead_ms: int = MARK_AHEAD_MS) -> DataFrame:
    """One line per feed (``value`` lines) that ends it, ``ahead_ms`` after its last row."""
    clock = F.max(F.split("value", ":")[0].try_cast("bigint")) + F.lit(ahead_ms)
    return feed.agg(clock.alias("t")).where("t IS NOT NULL").select(
        F.concat(F.col("t").cast("string"), F.lit(f":F0|end:,,,0,,{END_STATUS};:")).alias("value"))
