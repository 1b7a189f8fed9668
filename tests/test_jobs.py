"""The command-line jobs end to end on data derived from the events table."""

from __future__ import annotations

from touchline.operators import ball, frames, speed
from touchline.plans import jobs
from touchline.session import shared_dir
from touchline.sources import adapter, files


def test_ingest_and_features_jobs(spark, sf_dir):
    tracking = adapter.tracking(spark, sf_dir)
    frames_path, meta_path = shared_dir(spark, "job-frames"), shared_dir(spark, "job-meta")
    files.write_frames(adapter.nested_frames(tracking), frames_path)
    files.write_match_metadata(adapter.match_metadata(tracking), meta_path)
    players, ball_t, pf, bf = (shared_dir(spark, n) for n in ("players", "ball", "pfeat", "bfeat"))
    args = ["ingest", "--frames", frames_path, "--metadata", meta_path, "--players", players, "--ball", ball_t]
    jobs.main(args)
    jobs.main(args)  # a re-run inserts nothing
    jobs.main(["features", "--players", players, "--ball", ball_t, "--player-features", pf, "--ball-features", bf])

    fr = files.read_frames(spark, frames_path)
    assert files.read_table(spark, players).count() == frames.unified_players(fr).count()
    want = speed.player_performance(frames.unified_players(fr))
    got = files.read_table(spark, pf).select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect())

    meta = files.read_match_metadata(spark, meta_path)
    want_box = ball.ball_in_box_by_pitch(frames.unified_ball(fr), meta)
    got_box = files.read_table(spark, bf)
    assert sorted((r.match_date, r.n_times_inside_box) for r in got_box.collect()) == sorted(
        (r.match_id, r.n_times_inside_box) for r in want_box.collect()
    )


def test_stream_and_live_jobs(spark, sf_dir):
    from touchline.operators import events
    from touchline.streaming.lines import parse_ball_lines, split_parsed

    feed = shared_dir(spark, "job-feed")
    adapter.stream_lines(adapter.tracking(spark, sf_dir)).write.text(feed)
    rows, rows_ckpt, bad = shared_dir(spark, "job-rows"), shared_dir(spark, "job-rows-ckpt"), shared_dir(spark, "job-bad")
    live_out, live_ckpt = shared_dir(spark, "job-live"), shared_dir(spark, "job-live-ckpt")
    jobs.main(["stream", "--path", feed, "--sink", rows, "--checkpoint", rows_ckpt, "--quarantine", bad,
               "--available-now"])
    jobs.main(["live", "--path", feed, "--sink", live_out, "--checkpoint", live_ckpt, "--available-now"])

    lines = spark.read.text(feed)
    good, _ = split_parsed(parse_ball_lines(lines))
    assert files.read_table(spark, rows).count() == lines.count()
    want = events.live_events(good)
    got = files.read_table(spark, live_out).select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_ingest_job_quarantines_bad_frames(spark, sf_dir):
    import os

    tracking = adapter.tracking(spark, sf_dir)
    frames_path = shared_dir(spark, "job-frames-bad")
    files.write_frames(adapter.nested_frames(tracking), frames_path)
    with open(os.path.join(frames_path, "part-bad.json"), "w") as fh:
        fh.write('{"period": 1, "frameIdx": 7, "gameClock": "oops"\n')
    players, ball_t, bad = (shared_dir(spark, n) for n in ("players-q", "ball-q", "quarantine-q"))
    jobs.main(["ingest", "--frames", frames_path, "--players", players, "--ball", ball_t, "--quarantine", bad])
    good_frames = files.read_frames(spark, frames_path).where("wallClock IS NOT NULL")
    assert files.read_table(spark, ball_t).count() == good_frames.count()
    quarantined = spark.read.json(bad).collect()
    assert len(quarantined) == 1 and "corrupt" in quarantined[0]["reasons"]


def test_live_job_with_metadata_and_late_rows(spark, sf_dir):
    from touchline.operators import events
    from touchline.streaming import live
    from touchline.streaming.lines import parse_ball_lines, split_parsed

    tracking = adapter.tracking(spark, sf_dir)
    feed, meta, out, late, ckpt = (shared_dir(spark, n) for n in ("jl-feed", "jl-meta", "jl-out", "jl-late", "jl-ckpt"))
    adapter.stream_lines(tracking).write.text(feed)
    files.write_match_metadata(adapter.match_metadata(tracking), meta)
    args = ["live", "--path", feed, "--sink", out, "--checkpoint", ckpt, "--metadata", meta, "--late", late, "--available-now"]
    jobs.main(args)
    good, _ = split_parsed(parse_ball_lines(spark.read.text(feed)))
    want = events.live_events_by_pitch(good.drop("in_box", "in_field"), files.read_match_metadata(spark, meta))
    got = spark.read.parquet(out).select(*want.columns)
    assert sorted(got.collect()) == sorted(want.collect())
    # The first lines again, in a later file: all late.
    adapter.stream_lines(tracking.orderBy("wall_ms").limit(7)).coalesce(1).write.mode("append").text(feed)
    jobs.main(args)
    assert spark.read.parquet(late).where(f"kind = '{live.LATE_ROW}'").count() == 7
    assert spark.read.parquet(out).count() == want.count()
