"""Lines that are delivered again: each is stored once, and the state ends with the watermark."""

from __future__ import annotations

import os

from test_stream_chain import START, batch_rows, end, feed_lines, one_day, run, stream_rows, write_files

from touchline.operators import events
from touchline.session import shared_dir
from touchline.streaming import ingest, live


def deliver(path: str, name: str, lines: list[str], at: int) -> None:
    file = os.path.join(path, name)
    with open(file, "w") as f:
        f.writelines(v + "\n" for v in lines)
    os.utime(file, (1_700_000_100 + at, 1_700_000_100 + at))


def rows_of(df):
    return sorted(map(str, df.select("match_id", "wall_ms", "frame_idx", "ball_raw").collect()))


def test_each_delivery_once_over_micro_batches(spark):
    lines = one_day(feed_lines(11))
    path = write_files(spark, lines, 3, "repeats")
    deliver(path, "again.dat", lines[40:160], 1)  # a reconnect sends much of it again
    deliver(path, "twice-in-one.dat", [*lines[:30], *lines[:30]], 2)
    end(spark, path)
    got, q = run(spark, ingest.without_repeats(stream_rows(spark, path), "1 hour"))
    assert len([p for p in q.recentProgress if p["numInputRows"]]) >= 5
    assert rows_of(got.where("ball_status <> 'END_OF_FEED'")) == rows_of(batch_rows(spark, lines))


def test_state_ends_with_the_watermark(spark):
    lines = one_day(feed_lines(12))  # some 280 seconds of play
    path = write_files(spark, lines, 5, "bounded")
    end(spark, path)
    _, q = run(spark, ingest.without_repeats(stream_rows(spark, path), "10 seconds"))
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert max(held) < len(lines) and held[-1] <= 1  # at the end the mark's own key at most


def test_repeats_behind_the_watermark_are_late(spark):
    lines = one_day(feed_lines(13))
    path = write_files(spark, lines, 4, "late")
    deliver(path, "z1.dat", [f"{START + 10_000_000}:F1|p:1,2,0,1,A,Alive;:"], 1)
    deliver(path, "z2.dat", lines[:50], 2)
    deliver(path, "z3.dat", lines[:50], 3)
    got, q = run(spark, ingest.without_repeats(stream_rows(spark, path), "10 seconds"))
    assert got.count() == len(lines) + 1
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress) >= 50


def test_events_of_a_feed_that_is_sent_twice(spark):
    """Repeats removed, then the state of a match: two stateful operators in one query."""
    lines = one_day(feed_lines(14))
    path = write_files(spark, lines, 2, "chain")
    deliver(path, "again.dat", lines, 1)
    end(spark, path)
    once = ingest.without_repeats(stream_rows(spark, path), "1 hour").drop("event_time")
    got, _ = run(spark, live.live_event_stream(once, late_rows=True))
    want = events.live_events(batch_rows(spark, lines))
    key = ["wall_ms", "frame_idx", "seq", "kind", "message"]
    assert sorted(map(str, got.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))


def test_job_with_repeats_and_bad_lines(spark):
    lines = one_day(feed_lines(15, n=40))
    path, sink, ckpt, bad = (shared_dir(spark, n) for n in ("f", "s", "c", "q"))
    os.makedirs(path)
    deliver(path, "a.dat", [*lines, "no clock"], 1)
    deliver(path, "b.dat", [*lines, "no clock"], 2)
    raw = ingest.read_lines(spark, "text", path, 1)
    for q in ingest.start_ball_stream(raw, sink, ckpt, bad, available_now=True, repeats_within="1 hour"):
        q.awaitTermination()
    assert spark.read.parquet(sink).count() == len(lines) and spark.read.parquet(bad).count() == 2
