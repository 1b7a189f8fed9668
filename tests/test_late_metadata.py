"""Metadata as a stream of its own: sizes that come after the rows still reach them."""

from __future__ import annotations

import json
import os

import pytest

from touchline.functions.geometry import PITCH_LENGTH_M, PITCH_WIDTH_M
from touchline.session import shared_dir
from touchline.streaming import late_metadata, marks

START = 1_704_067_200_000
ROW = "match_id string, wall_ms long, frame_idx long, x double, ball_status string"
META = "match_id string, pitch_length double, pitch_width double, known_ms long"
HOUR = 3_600_000


def row(match, ms, idx=0):
    return {"match_id": match, "wall_ms": START + ms, "frame_idx": idx, "x": 1.0, "ball_status": "Alive"}


def meta(match, ms, length=100.0, width=64.0):
    return {"match_id": match, "pitch_length": length, "pitch_width": width, "known_ms": None if ms is None else START + ms}


END_ROW = {**row("end", 20 * HOUR), "ball_status": marks.END_STATUS}
END_META = late_metadata.metadata_end_mark(START + 20 * HOUR)


def put(path, name, records):
    """One file of records: one micro-batch of a stream that takes a file at a time."""
    os.makedirs(path, exist_ok=True)
    file = os.path.join(path, name)
    with open(file, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)
    at = 1_700_000_000 + len(os.listdir(path))
    os.utime(file, (at, at))


def run(spark, rows, metas, sink, ckpt):
    read = lambda schema, path: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(path)
    out = late_metadata.sized_rows(read(ROW, rows), read(META, metas), "1 minute", before="3 hours", patience="1 hour")
    q = out.writeStream.format("parquet").option("checkpointLocation", ckpt).option("path", sink).trigger(availableNow=True).start()
    q.awaitTermination()
    got = [(r.match_id, r.wall_ms - START, r.frame_idx, r.pitch_length, r.pitch_width) for r in spark.read.schema(out.schema).parquet(sink).collect()]
    return sorted(got), q


@pytest.fixture
def folders(spark):
    return [shared_dir(spark, n) for n in ("late-rows", "late-meta", "late-sink", "late-ckpt")]


def test_late_absent_repeated_and_unusable_metadata(spark, folders):
    rows, metas, sink, ckpt = folders
    put(rows, "0", [row("a", 0, 1), row("a", 1000, 2), row("a", 1000, 2), row("b", 500, 3), row("c", 700, 4)])
    put(metas, "0", [meta("x", 0), meta("c", None), meta("c", 100, None), meta(None, 5)])
    put(rows, "1", [row("a", 30 * 60_000, 5), row("b", 30 * 60_000, 6)])
    put(metas, "1", [meta("a", 10 * 60_000, 105.0, 68.0)])  # after kick-off
    put(rows, "2", [END_ROW])
    put(metas, "2", [meta("a", 11 * 60_000, 1.0, 1.0)])  # a second time, and long after
    put(metas, "3", [meta("a", 2 * HOUR, 2.0, 2.0)])
    put(metas, "4", [END_META])
    got, q = run(spark, rows, metas, sink, ckpt)
    default = (PITCH_LENGTH_M, PITCH_WIDTH_M)
    assert got == sorted([
        ("a", 0, 1, 105.0, 68.0), ("a", 1000, 2, 105.0, 68.0), ("a", 1000, 2, 105.0, 68.0), ("a", 30 * 60_000, 5, 105.0, 68.0),
        ("b", 500, 3, *default), ("b", 30 * 60_000, 6, *default), ("c", 700, 4, *default)])
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 3


def test_rows_wait_over_a_restart(spark, folders):
    """Nothing comes out while the metadata may still come; the wait survives a stop."""
    rows, metas, sink, ckpt = folders
    put(rows, "0", [row("a", 0, 1), row("b", 0, 2)])
    put(metas, "0", [meta("x", 0)])
    assert run(spark, rows, metas, sink, ckpt)[0] == []
    put(metas, "1", [meta("a", 59 * 60_000, 101.0, 65.0)])
    assert run(spark, rows, metas, sink, ckpt)[0] == [("a", 0, 1, 101.0, 65.0)]  # b waits on
    put(rows, "1", [END_ROW])
    put(metas, "2", [END_META])
    got, q = run(spark, rows, metas, sink, ckpt)
    assert got == [("a", 0, 1, 101.0, 65.0), ("b", 0, 2, PITCH_LENGTH_M, PITCH_WIDTH_M)]
    held = {s["operatorName"]: s["numRowsTotal"] for s in q.lastProgress["stateOperators"]}
    assert held["symmetricHashJoin"] <= 5  # the end marks (one copy per salt); no row or size is kept


def test_metadata_outside_the_window_is_not_taken(spark, folders):
    rows, metas, sink, ckpt = folders
    put(rows, "0", [row("early", 0), row("late", 4 * HOUR), row("edge", HOUR), row("edge", 3 * HOUR, 1)])
    put(metas, "0", [meta("early", HOUR + 1), meta("late", HOUR - 1), meta("edge", 2 * HOUR)])
    put(rows, "1", [END_ROW])
    put(metas, "1", [END_META])
    got, _ = run(spark, rows, metas, sink, ckpt)
    assert {(m, at): length for m, at, _, length, _ in got} == {
        ("early", 0): PITCH_LENGTH_M, ("late", 4 * HOUR): PITCH_LENGTH_M, ("edge", HOUR): 100.0, ("edge", 3 * HOUR): 100.0}


def test_empty_streams(spark, folders):
    rows, metas, sink, ckpt = folders
    put(rows, "0", [])
    put(metas, "0", [])
    assert run(spark, rows, metas, sink, ckpt)[0] == []


def test_rows_of_a_slot_wait_as_blocks(spark, folders):
    """The state of the join holds blocks, not rows; rows of a block are sized one by one."""
    rows, metas, sink, ckpt = folders
    put(rows, "0", [row("a", i * 1000, i) for i in range(600)] + [row("b", 4 * HOUR + i, i) for i in range(-30, 31)] + [row("a", 0, 0)])
    put(metas, "0", [meta("x", 0)])
    _, q = run(spark, rows, metas, sink, ckpt)
    held = {s["operatorName"]: s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]}
    assert 12 <= held["symmetricHashJoin"] < 100  # 662 rows in 12 slots
    put(metas, "1", [meta("b", HOUR)])  # three hours before some rows of its slots
    put(rows, "1", [END_ROW])
    put(metas, "2", [END_META])
    got, _ = run(spark, rows, metas, sink, ckpt)
    default = (PITCH_LENGTH_M, PITCH_WIDTH_M)
    want = [("a", i * 1000, i, *default) for i in [*range(600), 0]]
    want += [("b", 4 * HOUR + i, i, *((100.0, 64.0) if i <= 0 else default)) for i in range(-30, 31)]
    assert got == sorted(want)
