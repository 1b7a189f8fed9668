"""Streams: line parsing, quarantine, batch equality, restart, late rows."""

from __future__ import annotations

import os
import time

import pandas as pd
from pyspark.sql import functions as F

from touchline.operators import events
from touchline.session import shared_dir
from touchline.streaming import ingest, live
from touchline.streaming.lines import parse_ball_lines, split_parsed

T0 = 1_704_103_200_000  # 2024-01-01 10:00:00 UTC


def _line(i: int) -> str:
    # Walk the ball across the pitch: into the right box, over the goal line,
    # back, out over the touch line; status flips every 7 rows.
    x_cm = [0, 4500, 5300, 4600, 1000, 1000, -4700][i % 7]
    y_cm = [0, 0, 100, 0, 3500, 0, 500][i % 7]
    status = "Dead" if (i // 7) % 2 else "Alive"
    team = "A" if i % 3 else "B"
    return f"{T0 + i * 40}:F{i}|p1:{x_cm},{y_cm},0,{i % 9}.5,{team},{status};:"


def _write_file(folder: str, name: str, lines: list[str], mtime: float) -> None:
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    os.utime(path, (mtime, mtime))


def _run_live(spark, feed, sink, ckpt):
    good, _ = split_parsed(parse_ball_lines(ingest.read_lines(spark, "text", feed, max_files_per_trigger=1)))
    out = live.live_event_stream(good)
    q = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
         .option("path", sink).trigger(availableNow=True).start())
    q.awaitTermination()
    return out.schema


def _event_keys(rows):
    return sorted((r.wall_ms, r.seq, r.kind, r.old_value, r.new_value, r.message) for r in rows)


def test_parse_routes_bad_lines_to_quarantine(spark):
    lines = spark.createDataFrame(
        [(_line(1),), ("1704103200000:F1|p1:12.5x,100,0,1.0,A,Alive;:",), ("garbage",), ("17:F2:100;:",),
         ("99999999999999999999:F3|p1:100,100,0,1.0,A,Alive;:",), ("9999999999999999:F3|p1:100,100,0,1.0,A,Alive;:",)],
        "value string",
    )
    good, bad = split_parsed(parse_ball_lines(lines))
    # A line needs a clock; one without a position keeps its status, with null flags.
    rows = good.collect()
    assert [(r.x, r.in_box, r.ball_status) for r in rows[1:]] == [(None, None, "Alive"), (None, None, None)]
    assert bad.count() == 3
    row = rows[0]
    assert row.x == 45.0
    assert (row.in_box, row.in_field, row.ball_status, row.ball_team, row.frame_idx) == (True, True, "Alive", "A", 1)


def test_stream_equals_batch_and_restarts_without_duplicates(spark):
    feed, sink, ckpt = (shared_dir(spark, n) for n in ("feed", "live", "live-ckpt"))
    os.makedirs(feed)
    now = time.time() - 1000
    _write_file(feed, "a.txt", [_line(i) for i in range(0, 40)], now)
    _write_file(feed, "b.txt", [_line(i) for i in range(40, 80)], now + 10)
    schema = _run_live(spark, feed, sink, ckpt)
    first = spark.read.schema(schema).parquet(sink).count()
    _write_file(feed, "c.txt", [_line(i) for i in range(80, 120)], now + 20)
    _run_live(spark, feed, sink, ckpt)  # restart from the checkpoint
    streamed = spark.read.schema(schema).parquet(sink).collect()

    good, _ = split_parsed(parse_ball_lines(spark.read.text(feed)))
    batch = events.live_events(good).collect()
    assert 0 < first < len(streamed)
    assert _event_keys(streamed) == _event_keys(batch)
    assert len({(r.wall_ms, r.seq) for r in streamed}) == len(streamed)


def test_late_rows_are_dropped(spark):
    feed, sink, ckpt = (shared_dir(spark, n) for n in ("feed", "live", "live-ckpt"))
    os.makedirs(feed)
    now = time.time() - 1000
    _write_file(feed, "a.txt", [_line(i) for i in range(20, 40)], now)
    schema = _run_live(spark, feed, sink, ckpt)
    before = spark.read.schema(schema).parquet(sink).count()
    _write_file(feed, "b.txt", [_line(i) for i in range(0, 20)], now + 10)  # older clocks
    _run_live(spark, feed, sink, ckpt)
    assert spark.read.schema(schema).parquet(sink).count() == before
    state = live.live_state(spark, ckpt).collect()
    assert [(r.match_id, r.late_rows, r.last_frame_idx) for r in state] == [("2024-01-01", 20, 39)]


def test_ingest_stream_with_quarantine_and_restart(spark):
    feed, sink, ckpt, quarantine = (shared_dir(spark, n) for n in ("feed", "rows", "rows-ckpt", "bad"))
    os.makedirs(feed)
    now = time.time() - 1000
    _write_file(feed, "a.txt", [_line(i) for i in range(10)] + ["not a line"], now)
    lines = ingest.read_lines(spark, "text", feed)
    schema = parse_ball_lines(lines).schema
    for q in ingest.start_ball_stream(lines, sink, ckpt, quarantine, available_now=True):
        q.awaitTermination()
    _write_file(feed, "b.txt", [_line(i) for i in range(10, 15)], now + 10)
    for q in ingest.start_ball_stream(ingest.read_lines(spark, "text", feed), sink, ckpt, quarantine,
                                      available_now=True):
        q.awaitTermination()
    rows = spark.read.schema(schema).parquet(sink)
    assert rows.count() == 15 and rows.select("wall_ms").distinct().count() == 15
    assert spark.read.schema(schema).parquet(quarantine).where(F.col("wall_ms").isNull()).count() == 1


def test_event_time_mode_orders_out_of_order_feed(spark):
    feed, sink, ckpt = (shared_dir(spark, n) for n in ("feed", "live-ordered", "live-ordered-ckpt"))
    os.makedirs(feed)
    now = time.time() - 1000
    # The first micro-batch runs ahead to row 69; rows 50-59 come in the next
    # one, 760 ms behind the newest clock seen, within the 1 s delay.
    _write_file(feed, "a.txt", [_line(i) for i in list(range(0, 50)) + list(range(60, 70))], now)
    _write_file(feed, "b.txt", [_line(i) for i in list(range(50, 60)) + list(range(70, 120))], now + 10)
    good, _ = split_parsed(parse_ball_lines(ingest.read_lines(spark, "text", feed, max_files_per_trigger=1)))
    out = live.live_event_stream(good, delay="1 second")
    q = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
         .option("path", sink).trigger(availableNow=True).start())
    q.awaitTermination()
    streamed = spark.read.schema(out.schema).parquet(sink).collect()

    watermark = T0 + 119 * 40 - 1000  # rows up to it have been released
    batch_good, _ = split_parsed(parse_ball_lines(spark.read.text(feed)))
    batch = [r for r in events.live_events(batch_good).collect() if r.wall_ms <= watermark]
    assert len(streamed) > 0 and any(T0 + 50 * 40 <= r.wall_ms < T0 + 60 * 40 for r in batch)
    assert _event_keys(streamed) == _event_keys(batch)


class _MapState(dict):
    writes = 0

    def updateValue(self, key, value):
        self.writes += 1
        self[key] = value

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]


class _ValueState:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class _Handle:
    """State in this process, without any list state: a row must not be an entry of its own."""

    def __init__(self):
        self.maps, self.timers = {}, []

    def getValueState(self, name, schema):
        return _ValueState()

    def getMapState(self, name, key, value):
        return self.maps.setdefault(name, _MapState())

    def registerTimer(self, at):
        self.timers.append(at)


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_waiting_rows_are_blocks_in_the_state():
    big = 2**60 + 1  # frame numbers stay exact beside a missing one
    rows = pd.DataFrame([
        ("m", i, None, 1.0, None if i % 7 else 2.0, None, "Alive" if i % 3 else "Dead", i % 2 == 0, None)
        for i in range(1000)], columns=live.INPUT_COLUMNS)
    rows["frame_idx"] = pd.array([big + i if i % 5 else None for i in range(1000)], dtype="Int64")
    handle = _Handle()
    p = live.OrderedLiveEventProcessor()
    p.init(handle)
    assert not list(p.handleInputRows(("m",), iter([rows[500:], rows[:0]]), None))
    assert not list(p.handleInputRows(("m",), iter([rows[:500]]), None))
    pending = handle.maps["pending"]
    assert pending.writes == 2 and handle.timers == [500, 0]
    early = pd.concat(p.handleExpiredTimer(("m",), _Watermark(699), None))
    assert len(pending) == 1 and handle.timers == [500, 0, 700]  # what stays is written once
    late = pd.concat(p.handleExpiredTimer(("m",), _Watermark(2000), None))
    assert not pending and handle.timers == [500, 0, 700]
    want, _ = live.step(rows, ("Alive", False, True, None, None, 0))
    key = ["wall_ms", "seq", "kind", "old_value", "new_value"]
    got = pd.concat([early, late])
    assert sorted(got[key].itertuples(index=False, name=None)) == sorted(want[key].itertuples(index=False, name=None))
    assert set(got["frame_idx"].dropna()) <= {big + i for i in range(1000)}
