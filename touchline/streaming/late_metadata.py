"""Pitch sizes that come after kick-off: a stream-stream left join.

:func:`touchline.streaming.live.live_event_stream` takes a static metadata table, so a
match must be described before its first row. Here the metadata is a stream of its own.
A ball row waits in the join's state for the metadata of its match; once the watermark
says that none can come any more, it goes on with the default pitch (an outer row).

Both sides have a clock: the row's ``wall_ms``, and the metadata's ``known_ms``, when it
was sent. A row pairs with metadata sent from ``before`` ahead of it until ``patience``
after it, which bounds the state of both sides: rows are kept for ``patience`` plus the delay,
metadata for ``before`` plus the delay. A matched row goes on at once, an unmatched one
when both streams' watermarks (the slower counts) have passed its slot plus ``patience``; so a
metadata stream that is silent needs an end mark (:func:`metadata_end_mark`) or its
idle rows are held.

Rows wait as blocks: the rows of one match and one time slot that a task has met are one
state entry, an array, joined once. A match has at most one description, so which rows of
a block it is near enough to is decided row by row after the join, exactly. A block's event
time is its slot's end. The delay is a whole number of slots, so a row that is in time by its
own clock is in time by its slot; one that is late by less than a slot may still be taken.

Defined results: metadata with a null match, size or clock is unusable and pairs with
nothing. A match that is described again keeps the description that came first, so no row
pairs twice; the state for that is one id per match. Rows without a clock or a match take
no part (:func:`touchline.streaming.lines.split_parsed` rejects those without a clock).
Repeated rows stay repeated.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.geometry import PITCH_LENGTH_M, PITCH_WIDTH_M
from touchline.operators.events import PITCH_COLUMNS
from touchline.streaming.marks import without_end_marks

#: The match that a metadata end mark names; no match has this id.
END_MATCH = "END_OF_METADATA"
#: Widest slot of a block of waiting rows, and rows that a task holds at most to pack them.
SLOT_MS, BLOCK_ROWS = 60_000, 250_000
KEYS = ["_match", "_end"]


def first_described(metadata: DataFrame, delay: str) -> DataFrame:
    """A stream of ``match_id, pitch_length, pitch_width, known_ms`` with a watermark, each
    match once: the description that arrives first."""
    usable = metadata.where(" AND ".join(f"{c} IS NOT NULL" for c in ["match_id", "known_ms", *PITCH_COLUMNS]))
    return usable.withColumn("known_time", F.timestamp_millis("known_ms")).withWatermark("known_time", delay).dropDuplicates(["match_id"])


def _slot_ms(spark: SparkSession, delay: str) -> int:
    """The widest slot, ``SLOT_MS`` at most, of which ``delay`` is a whole number."""
    delay_ms = spark.range(1).select(F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {delay}"))).first()[0]
    return gcd(SLOT_MS, delay_ms)


def _blocks_of(rows: pa.Table) -> pa.RecordBatch:
    """One record per ``KEYS`` of the rows, the other columns as an array of structs."""
    rows = rows.take(pc.sort_indices(rows, [(k, "ascending") for k in KEYS])).combine_chunks()
    keys = [rows[k] for k in KEYS]
    new = np.ones(rows.num_rows, dtype=bool)
    for i, k in enumerate(keys):
        now, before = k.slice(1), k.slice(0, rows.num_rows - 1)
        same = pc.or_(pc.fill_null(pc.equal(now, before), False), pc.and_(now.is_null(), before.is_null()))
        new[1:] = ~same.to_numpy() if not i else new[1:] | ~same.to_numpy()
    begin = np.flatnonzero(new)
    columns = rows.drop_columns(KEYS)
    arrays = [c.combine_chunks() for c in columns.columns]
    inside = pa.StructArray.from_arrays([a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays], fields=list(columns.schema))
    block = pa.ListArray.from_arrays(pa.array([*begin, rows.num_rows], pa.int32()), inside)
    first = [k.combine_chunks().take(pa.array(begin)) for k in keys]
    return pa.RecordBatch.from_arrays([*first, block], names=[*KEYS, "_rows"])


def blocks(ball_rows: DataFrame, slot_ms: int) -> DataFrame:
    """``_match, _end`` (a slot's end in ms) ``, _rows``: rows dealt by match and slot, of which
    each task packs at most ``BLOCK_ROWS`` at a time."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= BLOCK_ROWS:
                yield _blocks_of(pa.Table.from_batches(held))
                held, n = [], 0
        if held:
            yield _blocks_of(pa.Table.from_batches(held))

    keyed = ball_rows.withColumns({"_match": F.col("match_id"), "_end": F.col("wall_ms") - F.pmod("wall_ms", F.lit(slot_ms)) + F.lit(slot_ms)})
    out = T.StructType([T.StructField("_match", T.StringType()), T.StructField("_end", T.LongType()),
                        T.StructField("_rows", T.ArrayType(ball_rows.schema))])
    return keyed.repartition(*KEYS).mapInArrow(pack, out)


def with_late_pitch(ball_rows: DataFrame, metadata: DataFrame, delay: str, before: str, patience: str, salts: int = 4) -> DataFrame:
    """Streaming ball rows with ``pitch_length`` and ``pitch_width`` of their match, from a
    metadata stream (see the module's text); rows whose match is never described have the
    default pitch. Append mode; ``event_time``, the end of a row's slot, is kept for later
    event-time operators.

    The blocks of one match are dealt over ``salts`` state partitions by their slot, and its
    one metadata row goes to each, so a hot match is not held by one task."""
    slot_ms = _slot_ms(ball_rows.sparkSession, delay)
    rows = blocks(ball_rows, slot_ms).withColumn("event_time", F.timestamp_millis("_end")).withWatermark("event_time", delay)
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_end"), F.lit(salts)).cast("int"))
    meta = first_described(metadata, delay).select(
        F.col("match_id").alias("_described"), "known_time", *PITCH_COLUMNS, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_part"))
    # Near some row that the slot could hold; the rows themselves are tested below.
    near = (
        (F.col("_match") == F.col("_described")) & (F.col("_salt") == F.col("_part"))
        & (F.col("known_time") >= F.col("event_time") - F.expr(f"INTERVAL {slot_ms} MILLISECONDS") - F.expr(f"INTERVAL {before}"))
        & (F.col("known_time") <= F.col("event_time") + F.expr(f"INTERVAL {patience}"))
    )
    joined = rows.join(meta, near, "left_outer").select("event_time", "known_time", *PITCH_COLUMNS, F.inline("_rows"))
    clock = F.timestamp_millis("wall_ms")
    taken = (F.col("known_time") >= clock - F.expr(f"INTERVAL {before}")) & (F.col("known_time") <= clock + F.expr(f"INTERVAL {patience}"))
    sized = [F.when(taken, F.col(c)).alias(c) for c in PITCH_COLUMNS]
    return joined.select(*ball_rows.columns, "event_time", *sized).fillna({"pitch_length": PITCH_LENGTH_M, "pitch_width": PITCH_WIDTH_M})


def sized_rows(ball_rows: DataFrame, metadata: DataFrame, delay: str, before: str, patience: str) -> DataFrame:
    """:func:`with_late_pitch` without the feed's end marks, as a table to store: its rows go to
    :func:`touchline.operators.events.live_events` in batch, whichever order they came in."""
    return without_end_marks(with_late_pitch(ball_rows, metadata, delay, before, patience)).drop("event_time")


def metadata_end_mark(known_ms: int) -> dict:
    """The record that ends a metadata stream: it moves the watermark and pairs with no row."""
    return {"match_id": END_MATCH, "pitch_length": PITCH_LENGTH_M, "pitch_width": PITCH_WIDTH_M, "known_ms": known_ms}
