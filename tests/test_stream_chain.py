"""Chained stateful streams: the poller in one query, slot-keyed state, batch-to-stream hand-over."""

from __future__ import annotations

import os
import random

import pandas as pd

from touchline.operators import ball, events
from touchline.session import shared_dir
from touchline.streaming import ingest, live, marks, sampling, slots
from touchline.streaming.lines import parse_ball_lines, split_parsed

START = 1_704_067_200_000  # 2024-01-01 00:00 UTC
KEY = ["match_id", "wall_ms", "frame_idx", "seq", "kind", "old_value", "new_value", "message"]


def feed_lines(seed: int, n: int = 400, days: int = 2, every_ms: int = 700) -> list[str]:
    """Random rows of two matches; some without a position, some with a clock shared by two rows."""
    rng, out = random.Random(seed), []
    for i in range(n):
        clock = START + (i % days) * 86_400_000 + (i // days // 2 * 2) * every_ms
        x, y = ("", "") if rng.random() < 0.1 else (rng.randint(-5800, 5800), rng.randint(-3800, 3800))
        out.append(f"{clock}:F{i}|p:{x},{y},0,1.5,{rng.choice('AB')},{rng.choice(['Alive', 'Alive', 'Dead'])};:")
    return out


def write_files(spark, lines: list[str], parts: int, name: str) -> str:
    """The lines in so many files, one micro-batch each, oldest first."""
    path = shared_dir(spark, name)
    os.makedirs(path)
    clock = sorted(lines, key=lambda v: int(v.split(":")[0]) % 86_400_000)  # both matches go on side by side
    for p in range(parts):
        file = os.path.join(path, f"{p:03d}.dat")
        with open(file, "w") as f:
            f.writelines(v + "\n" for v in clock[len(clock) * p // parts:len(clock) * (p + 1) // parts])
        os.utime(file, (1_700_000_000 + p, 1_700_000_000 + p))
    return path


def end(spark, path: str) -> None:
    line = marks.end_mark_lines(spark.read.text(path)).first()["value"]
    with open(os.path.join(path, "zzz.dat"), "w") as f:
        f.write(line + "\n")


def stream_rows(spark, path: str, files: int = 1):
    return split_parsed(parse_ball_lines(ingest.read_lines(spark, "text", path, files)))[0]


def batch_rows(spark, lines: list[str]):
    return split_parsed(parse_ball_lines(spark.createDataFrame([(v,) for v in lines], "value string")))[0]


def run(spark, out, ckpt=None, sink=None):
    sink, ckpt = sink or shared_dir(spark, "chain"), ckpt or shared_dir(spark, "chain-ckpt")
    q = out.writeStream.format("parquet").option("checkpointLocation", ckpt).option("path", sink).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(sink), q


def keys(df):
    return sorted(map(str, df.select(*KEY).collect()))


def one_day(lines):
    """Lines of one match: event time has one watermark for all, so days must not mix."""
    return [v for v in lines if int(v.split(":")[0]) < START + 86_400_000]


def test_poller_in_one_stream_equals_batch(spark):
    lines = one_day(feed_lines(1))
    path = write_files(spark, lines, 5, "poll")
    end(spark, path)
    got, q = run(spark, sampling.sampled_event_stream(stream_rows(spark, path)))
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 5  # several micro-batches
    assert len(q.lastProgress["stateOperators"]) == 2  # chained in one query
    assert keys(got) == keys(events.sampled_live_events(batch_rows(spark, lines)))


def test_poller_restarts_without_loss_or_repeats(spark):
    lines = one_day(feed_lines(2))
    path, sink, ckpt = write_files(spark, lines[:90], 2, "poll"), shared_dir(spark, "s"), shared_dir(spark, "c")
    run(spark, sampling.sampled_event_stream(stream_rows(spark, path)), ckpt, sink)
    with open(os.path.join(path, "later.dat"), "w") as f:
        f.writelines(v + "\n" for v in lines[90:])
    end(spark, path)
    got, _ = run(spark, sampling.sampled_event_stream(stream_rows(spark, path)), ckpt, sink)
    assert keys(got) == keys(events.sampled_live_events(batch_rows(spark, lines)))


def test_slot_state_equals_batch_at_every_width(spark):
    lines = one_day(feed_lines(3))
    want = keys(events.live_events(batch_rows(spark, lines)))
    path = write_files(spark, lines, 4, "slots")
    end(spark, path)
    for width in (1_000, 7_000, 3_600_000):
        got, _ = run(spark, slots.slot_event_stream(stream_rows(spark, path), "5 seconds", width))
        assert keys(got) == want, width


def test_a_match_is_many_calls_of_bounded_rows(spark, monkeypatch):
    """One match in one micro-batch: step 1 is called per slot, with that slot's rows alone."""
    original = slots.slot_summary

    def counting(rows, slot):
        out = original(rows, slot)
        extra = pd.DataFrame([(rows["match_id"].iloc[0], len(rows), None, 9, "CALL", None, None, None, None, None, slot)], columns=slots.SLOT_SCHEMA.names)
        return pd.concat([f for f in (out, extra) if len(f)], ignore_index=True)

    monkeypatch.setattr(slots, "slot_summary", counting)
    lines = one_day(feed_lines(4, n=600))
    path = write_files(spark, lines, 1, "bounded")
    end(spark, path)
    rows = stream_rows(spark, path, 2)
    got, _ = run(spark, slots.slot_rows(rows, "1 second", 10_000))
    calls = [(r.slot, r.wall_ms) for r in got.where("kind = 'CALL'").collect()]
    per_slot = 2 * (10_000 // 1_400 + 1)
    assert len(calls) == len({s for s, _ in calls}) >= 20 and sum(n for _, n in calls) == len(lines)
    assert max(n for _, n in calls) <= per_slot
    assert got.where("kind = 'SLOT_EDGE'").groupBy("slot").count().agg({"count": "max"}).first()[0] <= 3


def test_state_after_is_the_last_known_value(spark):
    rows = spark.createDataFrame(
        [("m", 1, 1, "Alive", True, None), ("m", 5, None, None, None, None), ("m", 5, 2, "Dead", None, False), ("m", None, 9, "Alive", False, True),
         ("n", 3, 1, None, None, None)],
        "match_id string, wall_ms long, frame_idx long, ball_status string, in_box boolean, in_field boolean")
    got = {r.match_id: tuple(r)[1:] for r in live.state_after(rows).collect()}
    assert got == {"m": ("Dead", True, False, 5, 2), "n": (None, None, None, 3, 1)}


def test_history_then_live_equals_all_batch(spark):
    lines = feed_lines(5)
    cut = sorted(int(v.split(":")[0]) % 86_400_000 for v in lines)[len(lines) // 2]
    past = [v for v in lines if int(v.split(":")[0]) % 86_400_000 < cut]
    later = [v for v in lines if int(v.split(":")[0]) % 86_400_000 >= cut]
    want = keys(events.live_events(batch_rows(spark, lines)))
    before = keys(events.live_events(batch_rows(spark, past)))
    path = write_files(spark, later, 3, "live")
    got, _ = run(spark, live.live_event_stream(stream_rows(spark, path), history=batch_rows(spark, past)))
    assert sorted(before + keys(got)) == want
    day = one_day(past), one_day(later)
    path = write_files(spark, day[1], 3, "live")
    end(spark, path)
    want = keys(events.live_events(batch_rows(spark, [*day[0], *day[1]])))
    before = keys(events.live_events(batch_rows(spark, day[0])))
    for stream in (lambda r, h: live.live_event_stream(r, delay="5 seconds", history=h), lambda r, h: slots.slot_event_stream(r, "5 seconds", 100, history=h)):
        got, _ = run(spark, stream(stream_rows(spark, path), batch_rows(spark, day[0])))
        assert sorted(before + keys(got)) == want


def test_rows_of_the_history_are_late_in_the_stream(spark):
    lines = one_day(feed_lines(6, n=60))
    path = write_files(spark, lines, 1, "again")  # the whole match is delivered again
    got, _ = run(spark, live.live_event_stream(stream_rows(spark, path), history=batch_rows(spark, lines), late_rows=True))
    assert [r.kind for r in got.collect()] == [live.LATE_ROW] * len(lines)


def test_new_matches_begin_with_the_initial_state(spark):
    lines = one_day(feed_lines(7, n=60))
    other = batch_rows(spark, lines).selectExpr("'2023-05-05' AS match_id", "wall_ms", "frame_idx", "'Dead' AS ball_status", "in_box", "in_field")
    path = write_files(spark, lines, 1, "new")
    got, _ = run(spark, live.live_event_stream(stream_rows(spark, path), history=other))
    assert keys(got) == keys(events.live_events(batch_rows(spark, lines)))


def test_sampled_state_is_unchanged(spark):
    lines = one_day(feed_lines(8))
    path = write_files(spark, lines, 3, "state")
    end(spark, path)
    got, _ = run(spark, sampling.sampled_state_stream(stream_rows(spark, path)))
    want = ball.sampled_ball_state(batch_rows(spark, lines))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
