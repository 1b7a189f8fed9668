"""Live ball events as one stateful Structured Streaming query.

The reference polls its output folder every few seconds from a driver loop and
keeps the last status, area and field flags in three driver variables. Here
the state lives in Spark's state store, one entry per match
(``groupBy("match_id").transformWithStateInPandas``, RocksDB provider), so the
query scales out by match and survives restarts from its checkpoint.

Per micro-batch and match the new rows are sorted by (wall clock, frame) and
compared with the previous row, the first one with the stored state, with the
same rules as the batch form (:func:`touchline.operators.events.live_events`).
Rows not newer than the last row already processed are late: they change nothing and
are counted in the state; with ``late_rows=True`` they also come out of the stream as
``LATE_ROW`` records, for a side output. The per-match work of one call is bounded by the
micro-batch size (``maxFilesPerTrigger`` / the feed rate); backfills of whole
seasons belong to the batch form, which splits matches into frame buckets.
Message texts are rendered afterwards by the shared Spark expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from touchline.operators.ball import ball_flags
from touchline.operators.events import (
    INITIAL_IN_BOX,
    INITIAL_IN_FIELD,
    INITIAL_STATUS,
    decorate_events,
    with_pitch,
)
from touchline.streaming.marks import is_end_mark, without_end_marks

STATE_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("in_box", T.BooleanType()),
    T.StructField("in_field", T.BooleanType()),
    T.StructField("last_wall_ms", T.LongType()),
    T.StructField("last_frame_idx", T.LongType()),
    T.StructField("late_rows", T.LongType()),
])

RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("wall_ms", T.LongType()),
    T.StructField("frame_idx", T.LongType()),
    T.StructField("seq", T.IntegerType()),
    T.StructField("kind", T.StringType()),
    T.StructField("old_value", T.StringType()),
    T.StructField("new_value", T.StringType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("ball_team", T.StringType()),
])
INPUT_COLUMNS = ["match_id", "wall_ms", "frame_idx", "x", "y", "ball_team", "ball_status", "in_box", "in_field"]

# (state column, seq, kind when the new value is true/other, kind when false)
SIGNALS = [
    ("ball_status", 1, "STATUS_CHANGED", "STATUS_CHANGED"),
    ("in_box", 2, "BOX_ENTERED", "BOX_LEFT"),
    ("in_field", 3, "FIELD_REENTERED", "FIELD_LEFT"),
]
NO_FRAME = -(2**63)

# Python workers get this module's processor by value, so executors need no
# installed copy of the library for the stateful step.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _previous_known(values: np.ndarray, known: np.ndarray, initial) -> np.ndarray:
    """For each position, the last known value strictly before it (else ``initial``)."""
    idx = np.where(known, np.arange(len(values)), -1)
    np.maximum.accumulate(idx, out=idx)
    before = np.empty(len(values), dtype=object)
    before[0] = initial
    if len(values) > 1:
        last = idx[:-1]
        before[1:] = np.where(last >= 0, values[np.maximum(last, 0)], initial)
    return before


#: The kind under which late rows leave the stream (``seq`` 0, no old or new value but the status).
LATE_ROW = "LATE_ROW"


def _late_records(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({
        "match_id": rows["match_id"].values, "wall_ms": rows["wall_ms"].values, "frame_idx": rows["frame_idx"].values,
        "seq": 0, "kind": LATE_ROW, "old_value": None, "new_value": rows["ball_status"].values,
        "x": rows["x"].values, "y": rows["y"].values, "ball_team": rows["ball_team"].values,
    })


def step(rows: pd.DataFrame, state: tuple, late_rows: bool = False) -> tuple[pd.DataFrame, tuple]:
    """Compare sorted rows with their predecessors; return (events, new state).

    Vectorised per signal (numpy): previous value = last non-null value before
    the row, the stored state before the first row.
    """
    status0, box0, field0, last_ms, last_fi, late = state
    frame = rows["frame_idx"].astype("Int64").fillna(NO_FRAME).astype("int64")  # exact beyond 2**53
    rows = rows.assign(_fi=frame).sort_values(["wall_ms", "_fi"], kind="mergesort")
    if last_ms is not None:
        newer = (rows["wall_ms"] > last_ms) | ((rows["wall_ms"] == last_ms) & (rows["_fi"] > last_fi))
        late += int((~newer).sum())
        out = [_late_records(rows[~newer])] if late_rows and not newer.all() else []
        rows = rows[newer]
    else:
        out = []
    if rows.empty:
        return out[0] if out else rows.iloc[0:0], (status0, box0, field0, last_ms, last_fi, late)

    new_state = []
    for (col, seq, kind_true, kind_false), initial in zip(SIGNALS, (status0, box0, field0)):
        cur = rows[col].to_numpy(dtype=object)
        known_at = pd.notna(cur)
        prev = _previous_known(cur, known_at, initial)
        changed = known_at & (cur != prev)
        if changed.any():
            hit = rows[changed]
            new_vals, old_vals = cur[changed], prev[changed]
            if col == "ball_status":
                kinds = [kind_true] * len(hit)
            else:
                kinds = [kind_true if bool(v) else kind_false for v in new_vals]
            out.append(pd.DataFrame({
                "match_id": hit["match_id"].values,
                "wall_ms": hit["wall_ms"].values,
                "frame_idx": hit["frame_idx"].values,
                "seq": seq,
                "kind": kinds,
                "old_value": [_text(v) for v in old_vals],
                "new_value": [_text(v) for v in new_vals],
                "x": hit["x"].values,
                "y": hit["y"].values,
                "ball_team": hit["ball_team"].values,
            }))
        known = cur[known_at]
        new_state.append(known[-1] if len(known) else initial)

    last = rows.iloc[-1]
    state_out = (
        str(new_state[0]) if new_state[0] is not None else None,
        bool(new_state[1]) if new_state[1] is not None else None,
        bool(new_state[2]) if new_state[2] is not None else None,
        int(last["wall_ms"]),
        int(last["_fi"]),
        late,
    )
    events = pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=RAW_EVENT_SCHEMA.names)
    return events, state_out


def _stored_state(history: pd.DataFrame) -> tuple:
    """One row of :func:`state_after` as the processors' state."""
    row = history.iloc[0]
    known = {c: (None if pd.isna(row[c]) else row[c]) for c in ("status", "in_box", "in_field", "last_wall_ms", "last_frame_idx")}
    return (
        INITIAL_STATUS if known["status"] is None else str(known["status"]),
        INITIAL_IN_BOX if known["in_box"] is None else bool(known["in_box"]),
        INITIAL_IN_FIELD if known["in_field"] is None else bool(known["in_field"]),
        None if known["last_wall_ms"] is None else int(known["last_wall_ms"]),
        None if known["last_frame_idx"] is None else int(known["last_frame_idx"]),
        0,
    )


class LiveEventProcessor(StatefulProcessor):
    """Per-match state: last status / area / field flags and the last row seen."""

    def __init__(self, late_rows: bool = False):
        self.late_rows = late_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("ball_state", STATE_SCHEMA)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.state.update(_stored_state(initialState))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        chunks = list(rows)
        if not chunks:
            return
        batch = pd.concat(chunks, ignore_index=True)
        if self.state.exists():
            stored = tuple(self.state.get())
        else:
            stored = (INITIAL_STATUS, INITIAL_IN_BOX, INITIAL_IN_FIELD, None, None, 0)
        events, new_state = step(batch, stored, self.late_rows)
        self.state.update(new_state)
        if len(events):
            yield events.astype({"seq": "int32"})[RAW_EVENT_SCHEMA.names]

    def close(self) -> None:
        pass


#: The waiting rows inside a block.
BUFFER_SCHEMA = pa.schema([
    ("match_id", pa.string()), ("wall_ms", pa.int64()), ("frame_idx", pa.int64()), ("x", pa.float64()), ("y", pa.float64()),
    ("ball_team", pa.string()), ("ball_status", pa.string()), ("in_box", pa.bool_()), ("in_field", pa.bool_()),
])


class PendingRows:
    """Rows that wait in a key's state for the watermark, as the Arrow blocks they came in.

    Map state with one entry a block, numbered as they came: adding a block is one write,
    however many rows wait already, and no row is an entry of its own."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.blocks = handle.getMapState("pending", "block long", "rows binary")
        self.count = handle.getValueState("pending_blocks", "n long")

    def add(self, chunks: Iterator[pd.DataFrame]) -> int | None:
        """Store the rows; their smallest clock, None if there are none."""
        first = n = self.count.get()[0] if self.count.exists() else 0
        low = None
        for chunk in chunks:
            if len(chunk):
                self._put(n, pa.RecordBatch.from_pandas(chunk[INPUT_COLUMNS], BUFFER_SCHEMA, preserve_index=False))
                n, least = n + 1, int(chunk["wall_ms"].min())
                low = least if low is None else min(low, least)
        if n > first:
            self.count.update((n,))
        return low

    def take(self, until: int | None = None) -> tuple[pd.DataFrame, int | None]:
        """Remove the rows with clocks up to ``until`` (None: all), in the order in which they
        came; also the smallest clock of the rows that stay, None if none do."""
        ready, low = [], None
        for n in sorted(key[0] for key in self.blocks.keys()):
            rows = pa.ipc.open_stream(self.blocks.getValue((n,))[0]).read_next_batch()
            due = pc.less_equal(rows["wall_ms"], until) if until is not None else None
            rest = rows.filter(pc.invert(due)) if due is not None else rows.slice(0, 0)
            if rest.num_rows:
                least = pc.min(rest["wall_ms"]).as_py()
                low = least if low is None else min(low, least)
            if rest.num_rows == rows.num_rows:
                continue
            ready.append(rows.filter(due) if rest.num_rows else rows)
            if rest.num_rows:
                self._put(n, rest)
            else:
                self.blocks.removeKey((n,))
        if low is None:
            self.count.clear()
        return pa.Table.from_batches(ready, BUFFER_SCHEMA).to_pandas(integer_object_nulls=True), low

    def _put(self, n: int, rows: pa.RecordBatch) -> None:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, BUFFER_SCHEMA) as out:
            out.write_batch(rows)
        self.blocks.updateValue((n,), (sink.getvalue().to_pybytes(),))


class OrderedLiveEventProcessor(StatefulProcessor):
    """Event-time variant for feeds that arrive out of order.

    New rows wait in the state (:class:`PendingRows`) until the watermark (largest clock seen
    minus the delay) has passed them; an event-time timer then processes them in
    clock order. Rows are late only when older than the watermark. Pending
    state per match is bounded by the delay times the feed rate.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("ball_state", STATE_SCHEMA)
        self.pending = PendingRows(handle)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.state.update(_stored_state(initialState))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        low = self.pending.add(rows)
        if low is not None:
            # Fires once the watermark passes the oldest new row.
            self.handle.registerTimer(low)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ready, low = self.pending.take(timerValues.getCurrentWatermarkInMs())
        if low is not None:
            self.handle.registerTimer(low)
        if not len(ready):
            return
        if self.state.exists():
            stored = tuple(self.state.get())
        else:
            stored = (INITIAL_STATUS, INITIAL_IN_BOX, INITIAL_IN_FIELD, None, None, 0)
        events, new_state = step(ready, stored)
        self.state.update(new_state)
        if len(events):
            yield events.astype({"seq": "int32"})[RAW_EVENT_SCHEMA.names]

    def close(self) -> None:
        pass


def state_after(history: DataFrame) -> DataFrame:
    """``match_id`` and the state after the last row of each match of a batch table: the
    last known status and flags and the last row's clock and frame. Partial aggregates of
    one small struct a signal, so a hot match is one row per task in the shuffle."""
    rows = history.where(F.col("wall_ms").isNotNull()).withColumn("_at", F.struct("wall_ms", F.coalesce("frame_idx", F.lit(NO_FRAME)).alias("f")))
    last = {"status": "ball_status", "in_box": "in_box", "in_field": "in_field"}
    found = rows.groupBy("match_id").agg(
        *[F.max(F.when(F.col(c).isNotNull(), F.struct("_at", F.col(c).alias("v")))).alias(name) for name, c in last.items()],
        F.max("_at").alias("_last"))
    return found.select("match_id", *[F.col(f"{name}.v").alias(name) for name in last],
                        F.col("_last.wall_ms").alias("last_wall_ms"), F.col("_last.f").alias("last_frame_idx"))


def _with_state(rows: DataFrame, processor: StatefulProcessor, time_mode: str, history: DataFrame | None) -> DataFrame:
    before = state_after(history).groupBy("match_id") if history is not None else None
    return rows.groupBy("match_id").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=RAW_EVENT_SCHEMA,
        outputMode="Append",
        timeMode=time_mode,
        initialState=before,
    )


def event_time_events(rows: DataFrame, history: DataFrame | None = None, **dims) -> DataFrame:
    """Rows with a watermarked ``event_time`` (also those of an upstream stateful operator)
    → decorated events, in clock order."""
    raw = _with_state(rows.select(*INPUT_COLUMNS, "event_time"), OrderedLiveEventProcessor(), "EventTime", history)
    return decorate_events(raw, **dims)


def live_event_stream(ball_rows: DataFrame, length=None, width=None, delay: str | None = None,
                      metadata: DataFrame | None = None, late_rows: bool = False,
                      history: DataFrame | None = None) -> DataFrame:
    """Streaming ball rows (parsed, flagged) → decorated live events.

    Without ``delay`` rows are processed as their micro-batch arrives (the feed
    must be in clock order across batches). With ``delay`` (e.g. ``"10 seconds"``)
    the stream is ordered by event time: rows are held until the watermark passes
    them, so disorder up to ``delay`` is tolerated and events appear ``delay``
    after the play. An end mark (:func:`end_mark_lines`) releases the rest of a feed.

    ``metadata`` (a static table of match_id, pitch_length, pitch_width) gives each match
    its own pitch for the flags and the restart rule. ``late_rows`` (arrival mode only)
    adds the rows that came too late as records of kind ``LATE_ROW``.

    ``history`` (flagged ball rows of a batch table) is what came before the stream: its
    matches begin with the state after their last row (:func:`state_after`) instead of the
    initial one, and stream rows not newer than that row are late. It is read once, by the
    query's first micro-batch; a restart goes on from the checkpoint.
    """
    if metadata is not None:
        sized = with_pitch(ball_rows, metadata)
        size = F.col("pitch_length"), F.col("pitch_width")
        ball_rows = ball_flags(sized.drop("in_box", "in_field"), *size)
    rows = ball_rows.select(*INPUT_COLUMNS)
    if delay is None:
        processor, time_mode = LiveEventProcessor(late_rows), "None"
        rows = rows.where(~is_end_mark(F.col("ball_status")))
    else:
        rows = without_end_marks(rows.withColumn("event_time", F.timestamp_millis("wall_ms")).withWatermark("event_time", delay))
        processor, time_mode = OrderedLiveEventProcessor(), "EventTime"
    raw = _with_state(rows, processor, time_mode, history)
    if metadata is not None:
        return decorate_events(with_pitch(raw, metadata), F.col("pitch_length"), F.col("pitch_width"))
    dims = {k: v for k, v in (("length", length), ("width", width)) if v is not None}
    return decorate_events(raw, **dims)


def live_state(spark, checkpoint: str) -> DataFrame:
    """The per-match state of a live-event query, read from its checkpoint with
    the state store reader: last status and flags, last row, late rows dropped."""
    state = spark.read.format("statestore").option("stateVarName", "ball_state").load(checkpoint)
    return state.select(F.col("key.match_id").alias("match_id"), "value.*")
