"""Epoch-millisecond clocks to dates, timestamps and display text.

The reference formats ``from_unixtime(ms / 1000)``, which drops the milliseconds.
Here the typed timestamp keeps them; text is only a display column. Dates are in
the session time zone, which :func:`touchline.session.configure` pins to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
DISPLAY_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


# Clocks beyond +-10^15 ms (year 33,000) are bad numbers; they map to null
# instead of overflowing (an error with ANSI arithmetic).
MAX_ABS_MS = 10**15


def ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(F.when(F.abs(ms) < F.lit(MAX_ABS_MS), ms))


def match_date(ms: Column) -> Column:
    """The match day of an epoch-ms clock as ``yyyy-MM-dd`` text."""
    return F.date_format(ms_to_timestamp(ms), DATE_FORMAT)


def display_time(ms: Column) -> Column:
    return F.date_format(ms_to_timestamp(ms), DISPLAY_FORMAT)
