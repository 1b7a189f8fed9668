"""Visits to the penalty area: maximal runs of rows with the ball inside, per match.

A gaps-and-islands problem on sequences that must not meet in one task. A run number
counted over a match would be one window per match. Instead each (match, time slot) finds
its own runs of equal flag, inside and outside, in one pass over the rows; only a slot's
first and last run can go on in another slot. Those, at most two rows a slot, are joined
along the match: neighbours of different slots with the same flag are one run. Joining
runs is associative, so the slot width changes the work per task and never the result.

Rows are ordered by (wall clock, frame). Rows without a flag or a clock take no part: a
visit goes on over them. Clock ties between matches of one id are ordered by the frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.sequence import SLOT_SECONDS, time_slot


def slot_runs(flagged: DataFrame, flag: str = "in_box", slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """Runs of equal flag inside each (match, slot): ``match_id, slot, run`` (from 1),
    ``last_run`` of the slot, ``inside``, ``start_ms, end_ms, n_rows``."""
    rows = flagged.where(F.col(flag).isNotNull() & F.col("wall_ms").isNotNull()).select(
        "match_id", time_slot("wall_ms", slot_seconds * 1000.0).alias("slot"), "wall_ms", "frame_idx", F.col(flag).alias("inside"))
    order = Window.partitionBy("match_id", "slot").orderBy("wall_ms", "frame_idx")
    turn = F.coalesce(F.col("inside") != F.lag("inside").over(order), F.lit(True)).cast("int")
    rows = rows.withColumn("_turn", turn).withColumn("run", F.sum("_turn").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = rows.groupBy("match_id", "slot", "run").agg(
        F.max("inside").alias("inside"), F.min("wall_ms").alias("start_ms"), F.max("wall_ms").alias("end_ms"), F.count("*").alias("n_rows"))
    return runs.withColumn("last_run", F.max("run").over(Window.partitionBy("match_id", "slot")))


def visits(flagged: DataFrame, flag: str = "in_box", slot_seconds: float = SLOT_SECONDS) -> DataFrame:
    """``match_id, start_ms, end_ms, seconds, n_rows`` of every visit: the clocks of its
    first and last row, the time between them, and its rows."""
    runs = slot_runs(flagged, flag, slot_seconds)
    at_edge = (F.col("run") == 1) | (F.col("run") == F.col("last_run"))
    columns = ["match_id", "start_ms", "end_ms", "n_rows"]
    whole = runs.where(~at_edge & F.col("inside")).select(*columns)
    along = Window.partitionBy("match_id").orderBy("slot", "run")
    goes_on = (F.lag("inside").over(along) == F.col("inside")) & (F.lag("slot").over(along) < F.col("slot"))
    edges = runs.where(at_edge).withColumn("_new", F.when(goes_on, 0).otherwise(1))
    edges = edges.withColumn("_visit", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    joined = edges.groupBy("match_id", "_visit").agg(
        F.max("inside").alias("inside"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.sum("n_rows").alias("n_rows"))
    found = whole.unionByName(joined.where("inside").select(*columns))
    return found.select("match_id", "start_ms", "end_ms", ((F.col("end_ms") - F.col("start_ms")) / F.lit(1000.0)).alias("seconds"), "n_rows")
