"""Live events with state keyed by (match, time slot): a match is many tasks' work.

The per-match processors of :mod:`touchline.streaming.live` see a match's whole
micro-batch in one call. A backlog of a long match, or a feed that holds a third of all
rows, is then one task. Here two stateful operators are chained in one query (append mode):

1. ``groupBy(match_id, slot)``, event time: a slot's rows wait in the state until the
   watermark has passed the slot's end; its timer then emits the events between the
   slot's own rows and, per signal, one edge: where the signal is first known in the slot,
   with its first and its last value. A call sees the rows of one slot, whatever the match
   or the backlog; slots of a match lie on different tasks.
2. ``groupBy(match_id)``: the three values carried from slot to slot. A call sees the
   edges, at most three a slot, and hands the events through. Slots reach it in clock
   order, since the watermark passes their ends in that order.

Events, their order keys and texts are those of the batch form. Rows behind the watermark
are dropped by Spark before step 1 and counted in the query's progress
(``numRowsDroppedByWatermark``). An end mark releases the last slots of a finished feed.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from touchline.operators.events import INITIAL_IN_BOX, INITIAL_IN_FIELD, INITIAL_STATUS, decorate_events
from touchline.streaming.live import (
    INPUT_COLUMNS,
    RAW_EVENT_SCHEMA,
    SIGNALS,
    PendingRows,
    _text,
    state_after,
    step,
)
from touchline.streaming.marks import without_end_marks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Width of a slot: at 25 rows a second a call sees 1,500 rows.
SLOT_MS = 60_000
EDGE = "SLOT_EDGE"
SLOT_SCHEMA = T.StructType([*RAW_EVENT_SCHEMA.fields, T.StructField("slot", T.LongType())])
CARRY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c, *_ in SIGNALS])
INITIAL = (INITIAL_STATUS, _text(INITIAL_IN_BOX), _text(INITIAL_IN_FIELD))


def slot_summary(rows: pd.DataFrame, slot: int) -> pd.DataFrame:
    """The events inside one slot, and per signal its edge: ``old_value`` is the first known
    value, ``new_value`` the last, the other columns are those of the row that is first."""
    frame = rows["frame_idx"].astype("Int64").fillna(-(2**63)).astype("int64")
    rows = rows.assign(_fi=frame).sort_values(["wall_ms", "_fi"], kind="mergesort")
    first, edges = [], []
    for col, seq, *_ in SIGNALS:
        known = rows[rows[col].notna()]
        first.append(None)
        if len(known):
            head = known.iloc[0]
            ends = [known[col].iloc[i] if col == "ball_status" else bool(known[col].iloc[i]) for i in (0, -1)]
            first[-1] = ends[0]
            edges.append((head["match_id"], head["wall_ms"], head["frame_idx"], seq, EDGE, *map(_text, ends), head["x"], head["y"], head["ball_team"]))
    # A signal that starts from its own first value has no event before its second one.
    inner, _ = step(rows.drop(columns="_fi"), (*first, None, None, 0))
    out = pd.concat([f for f in (inner, pd.DataFrame(edges, columns=RAW_EVENT_SCHEMA.names)) if len(f)], ignore_index=True) \
        if len(inner) or edges else pd.DataFrame(columns=RAW_EVENT_SCHEMA.names)
    return out.assign(slot=slot)


def join_slots(edges: pd.DataFrame, carried: tuple) -> tuple[list[tuple], tuple]:
    """Events at the slots' heads, and what is carried on, from edges in any order."""
    carried, events = list(carried), []
    for e in edges.sort_values(["slot", "seq"]).itertuples(index=False):
        i = e.seq - 1
        _, seq, kind_true, kind_false = SIGNALS[i]
        if e.old_value != carried[i]:
            kind = kind_true if i == 0 or e.old_value == "true" else kind_false
            events.append((e.match_id, e.wall_ms, e.frame_idx, seq, kind, carried[i], e.old_value, e.x, e.y, e.ball_team))
        carried[i] = e.new_value
    return events, tuple(carried)


def _typed(pdf: pd.DataFrame, names: list[str]) -> pd.DataFrame:
    return pdf.astype({"seq": "int32"})[names]


class SlotProcessor(StatefulProcessor):
    """One slot of one match: its rows until the watermark has passed it."""

    def __init__(self, width_ms: int):
        self.width_ms = width_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = PendingRows(handle)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self.pending.add(rows)
        self.handle.registerTimer((int(key[1]) + 1) * self.width_ms)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows, _ = self.pending.take()
        out = slot_summary(rows, int(key[1])) if len(rows) else rows
        if len(out):
            yield _typed(out, SLOT_SCHEMA.names)

    def close(self) -> None:
        pass


class MatchProcessor(StatefulProcessor):
    """One match: the last known value of each signal, carried over its slots."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.carried = handle.getValueState("carried", CARRY_SCHEMA)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        known = [row["status"], row["in_box"], row["in_field"]]
        self.carried.update(tuple(i if pd.isna(v) else _text(v if c == "ball_status" else bool(v)) for v, i, (c, *_) in zip(known, INITIAL, SIGNALS)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        edges = []
        for chunk in rows:
            is_edge = chunk["kind"] == EDGE
            edges.append(chunk[is_edge])
            if not is_edge.all():
                yield _typed(chunk[~is_edge], RAW_EVENT_SCHEMA.names)
        stored = tuple(self.carried.get()) if self.carried.exists() else INITIAL
        events, carried = join_slots(pd.concat(edges, ignore_index=True), stored)
        self.carried.update(carried)
        if events:
            yield _typed(pd.DataFrame(events, columns=RAW_EVENT_SCHEMA.names), RAW_EVENT_SCHEMA.names)

    def close(self) -> None:
        pass


def slot_rows(ball_rows: DataFrame, delay: str, width_ms: int = SLOT_MS) -> DataFrame:
    """Step 1: events inside the slots, and the slots' edges (``kind`` ``SLOT_EDGE``)."""
    rows = ball_rows.select(*INPUT_COLUMNS).withColumn("event_time", F.timestamp_millis("wall_ms")).withWatermark("event_time", delay)
    rows = without_end_marks(rows).withColumn("slot", F.floor(F.col("wall_ms") / F.lit(width_ms)))
    return rows.groupBy("match_id", "slot").transformWithStateInPandas(
        statefulProcessor=SlotProcessor(width_ms), outputStructType=SLOT_SCHEMA, outputMode="Append", timeMode="EventTime")


def slot_event_stream(ball_rows: DataFrame, delay: str, width_ms: int = SLOT_MS, history: DataFrame | None = None, **dims) -> DataFrame:
    """Streaming ball rows → live events by slots (see the module). ``history`` as in
    :func:`touchline.streaming.live.live_event_stream`; slots that it has rows of must not
    be in the stream."""
    before = state_after(history).groupBy("match_id") if history is not None else None
    raw = slot_rows(ball_rows, delay, width_ms).groupBy("match_id").transformWithStateInPandas(
        statefulProcessor=MatchProcessor(), outputStructType=RAW_EVENT_SCHEMA, outputMode="Append", timeMode="None", initialState=before)
    return decorate_events(raw, **dims)
