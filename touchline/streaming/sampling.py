"""What a poller would see, as a streaming event-time aggregation.

The reference looks at the newest stored row every 3 seconds of wall time. The
stream form keeps, per match and per 3-second tumbling window of the feed's
own clock, the newest row (``max_by`` on (clock, frame)). A watermark bounds the
state: a window is emitted (append mode) once the watermark, the largest clock
seen minus ``delay``, has passed its end, and rows older than the watermark are
dropped as late. An end mark (:mod:`touchline.streaming.marks`) closes the last windows
of a finished feed.

:func:`sampled_event_stream` is the poller's whole loop as one query: the window aggregate
feeds a second stateful operator, in event time, that compares a match's windows with its
stored state. A window leaves the aggregate once, after all earlier ones of its match, and
waits in the second operator until the watermark handed on by the first has passed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.ball import SAMPLE_MS, STATE_COLUMNS
from touchline.streaming.live import event_time_events
from touchline.streaming.marks import is_end_mark, without_end_marks

DELAY = "10 seconds"


def _newest_per_window(ball_rows: DataFrame, every_ms: int, delay: str) -> DataFrame:
    """Closed windows with ``event_time``, which carries the watermark on."""
    newest = F.max_by(F.struct(*STATE_COLUMNS), F.struct("wall_ms", "frame_idx"))
    rows = ball_rows.withColumn("event_time", F.timestamp_millis("wall_ms")).withWatermark("event_time", delay)
    closed = rows.groupBy("match_id", F.window("event_time", f"{every_ms} milliseconds").alias("w")).agg(newest.alias("s"))
    return closed.select(
        "match_id",
        F.unix_millis(F.col("w.start")).alias("window_start_ms"),
        *[F.col(f"s.{c}").alias(c) for c in STATE_COLUMNS],
        F.window_time("w").alias("event_time"),
    )


def sampled_state_stream(ball_rows: DataFrame, every_ms: int = SAMPLE_MS, delay: str = DELAY) -> DataFrame:
    # An end mark moves the watermark from a window of its own, far after the feed's last.
    return _newest_per_window(ball_rows, every_ms, delay).drop("event_time").where(~is_end_mark(F.col("ball_status")))


def sampled_event_stream(ball_rows: DataFrame, every_ms: int = SAMPLE_MS, delay: str = DELAY, **dims) -> DataFrame:
    """Streaming ball rows → the events a poller would report, in one query of two chained
    stateful operators (append mode). ``dims``: ``length``, ``width`` of the pitch."""
    windows = without_end_marks(_newest_per_window(ball_rows, every_ms, delay))
    return event_time_events(windows, **dims)
