"""Legal but awkward input: restarting counters, nulls, two matches a day, repeated keys."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import ball, events, frames, speed, tables
from touchline.operators.sequence import time_slot, with_previous
from touchline.plans import jobs
from touchline.session import checkpoint_base, shared_dir
from touchline.sources import adapter, files
from touchline.streaming import live
from touchline.streaming.lines import parse_ball_lines, split_parsed

BALL = ("match_id string, wall_ms long, frame_idx long, x double, y double, ball_team string, ball_status string, "
        "in_box boolean, in_field boolean")


def _ball(spark, rows):
    return spark.createDataFrame([("m", ms, fi, 0.0, 0.0, "A", st, False, True) for ms, fi, st in rows], BALL)


def _changes(df):
    return sorted((r.wall_ms, r.old_value, r.new_value) for r in df.collect() if r.kind == "STATUS_CHANGED")


@pytest.mark.parametrize("slot", [0.001, 0.5, 3600.0])
def test_frame_counter_may_restart_or_be_null(spark, slot):
    rows = [(0, 0, "Alive"), (1000, 70000, "Dead"), (2000, 1, "Dead")]
    assert _changes(events.live_events(_ball(spark, rows), slot_seconds=slot)) == [(1000, "Alive", "Dead")]
    rows = [(0, 5, "Alive"), (1000, None, "Dead"), (2000, 6, "Alive")]
    assert _changes(events.live_events(_ball(spark, rows), slot_seconds=slot)) == [(1000, "Alive", "Dead"), (2000, "Dead", "Alive")]


def test_rows_without_a_clock_are_handed_out(spark):
    df = _ball(spark, [(0, 0, "Alive"), (None, 1, "Dead"), (10, 2, "Dead")])
    assert _changes(events.live_events(df)) == [(10, "Alive", "Dead")]
    assert [r.frame_idx for r in events.unordered(df).collect()] == [1]


@pytest.mark.parametrize("width", [7.0, 1e9])
def test_slot_width_changes_no_result(spark, sf_dir, width):
    t = adapter.with_gaps(adapter.tracking(spark, sf_dir))
    flagged = ball.ball_flags(adapter.ball_rows(t))
    for make in (
        lambda w: events.live_events(flagged, **w), lambda w: speed.frame_speed_x(t, **w),
        lambda w: speed.player_performance(t) if not w else speed.player_features(t, **w), lambda w: speed.max_speed_x_zero_fill(t, **w),
    ):
        assert sorted(map(repr, make({}).collect())) == sorted(map(repr, make({"slot_seconds": width}).collect()))


def test_a_signal_that_stays_null_sends_one_row_per_slot_upward(spark):
    df = spark.range(0, 20_000).select(F.lit("m").alias("k"), F.col("id").alias("t"), F.lit(None).cast("string").alias("v"))
    out = with_previous(df, ["k"], ["t"], time_slot("t", 100.0), ["v"], ignore_nulls=True)
    assert out.count() == 20_000 and out.where("prev_v IS NOT NULL").count() == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # The window over the key alone stands on a filter: the slots' first rows (no row before in the slot).
    at = next(i for i, line in enumerate(plan) if "Window [last(__s0_t_v" in line)
    assert any("Filter isnull(_we" in line for line in plan[at + 1:at + 4])


def test_zero_fill_fills_positions_clocks_and_lags(spark):
    cols = "side string, player_id string, period int, game_clock double, frame_idx long, x double, speed double"
    for step, want in ((0.04, 125.0), (0.01, 500.0)):
        rows = [("home", "p", 1, 1 + i * step, i, x, 0.0) for i, x in enumerate([1.0, None, 5.0])]
        for width in (0.005, 10.0):
            got = speed.max_speed_x_zero_fill(spark.createDataFrame(rows, cols), slot_seconds=width).first()
            assert got.maximum_speed_x == pytest.approx(want)
    untimed = spark.createDataFrame([("home", "p", 1, None, 0, 3.0, 0.0), ("home", "p", 1, 2.0, 1, 5.0, 0.0)], cols)
    assert speed.max_speed_x_zero_fill(untimed).first().maximum_speed_x == 1.0  # (5 - 3) / (2 - 0)


def _frame(idx, match, period, wall, home=("h1",), ball_xyz=(1.0, 2.0, 0.0), clock=1.0):
    p = lambda pid: (pid, 1.5, [0.5, -0.5, 0.0])
    return (match, period, idx, clock, wall, True, "home", [p(x) for x in home], [p("a1")], (list(ball_xyz), 3.0))


def _frames(spark, rows):
    return spark.createDataFrame(rows, schemas.FRAME_WITH_ID)


def test_two_matches_of_a_day_extra_time_and_bad_rows_are_all_accounted_for(spark):
    wall = 1_700_000_000_000
    rows = [_frame(i, m, per, wall + i * 40) for m in ("m1", "m2") for per in (1, 2, 3, 4, 5) for i in (1, 2)]
    rows.append(_frame(9, "m1", 1, wall, home=("h1", None)))  # one nameless player
    rows.append(_frame(10, "m1", 1, wall, ball_xyz=(1.0, 2.0)[:1]))  # a ball without a place
    rows += [_frame(11, "m1", 8, wall), _frame(12, "m1", 1, 10**16), _frame(13, "m1", 1, wall, clock=None)]
    rows += [rows[0]]  # delivered twice
    path, players, balls, bad = (shared_dir(spark, n) for n in ("f", "p", "b", "q"))
    files.write_frames(_frames(spark, rows), path)
    counts = jobs.ingest(spark, path, None, players, balls, bad)
    assert counts["frames_read"] == 25 == counts["ball_rows"] + counts["ball_rejects"] + counts["frame_rejects"]
    assert (counts["player_rows"], counts["player_rejects"], counts["ball_rejects"], counts["frame_rejects"]) == (44, 1, 1, 3)
    assert counts == jobs.ingest(spark, path, None, players, balls, bad)
    stored = files.read_table(spark, players)
    assert stored.count() == 44 and sorted(r[0] for r in stored.select("match_date").distinct().collect()) == ["m1", "m2"]
    assert sorted(r[0] for r in stored.select("period").distinct().collect()) == [1, 2, 3, 4, 5]
    # A late file of a stored match is added.
    files.write_frames(_frames(spark, [_frame(99, "m1", 2, wall)]), late := shared_dir(spark, "late"))
    jobs.ingest(spark, late, None, players, balls)
    assert files.read_table(spark, players).count() == 46
    assert spark.read.json(bad).count() == 10  # two runs


def test_different_frames_under_one_key_both_stay(spark):
    fr = _frames(spark, [_frame(1, "m1", 1, 10), _frame(1, "m2", 1, 10), _frame(1, "m1", 1, 10), _frame(1, "m1", 1, 10, home=("h2",))])
    assert frames.dedup_frames(fr).count() == 3


def test_a_line_without_position_keeps_its_status(spark):
    lines = spark.createDataFrame([("1000:F1|p:100,100,0,1.0,A,Alive;:",), ("2000:F2|p:,,0,1.0,A,Dead;:",)], "value string")
    good, bad = split_parsed(parse_ball_lines(lines))
    assert bad.count() == 0
    assert _changes(events.live_events(good)) == [(2000, "Alive", "Dead")]
    named = parse_ball_lines(lines, match_id=F.lit("final"))
    assert {r.match_id for r in named.collect()} == {"final"}


FEATS = "side string, player_id string, player_avg_speed double, player_max_speed double, maximum_speed_x double, match_date string"
KEYS = ["match_date", "side", "player_id"]


def test_upsert_rejects_a_key_twice(spark):
    twice = spark.createDataFrame([("home", "p", 1.0, 1.0, 1.0, "d"), ("home", "p", 2.0, 1.0, 1.0, "d")], FEATS)
    path = shared_dir(spark, "twice")
    with pytest.raises(ValueError, match="2 rows for one key"):
        tables.upsert_by_key(spark, twice, path, KEYS)
    assert not files.path_exists(spark, path)


def test_null_keys_are_not_inserted_again(spark):
    src = spark.createDataFrame([("home", None, 1.0, 1.0, 1.0, "d")], FEATS)
    path = shared_dir(spark, "nulls")
    for _ in range(3):
        tables.merge_insert_only(spark, src, path, KEYS, schema=schemas.PLAYER_FEATURES)
    assert files.read_table(spark, path, schemas.PLAYER_FEATURES).count() == 1


def test_merges_read_touched_partitions_only_and_matches_are_few_files(spark):
    rows = [("home", f"p{i}", 1.0, 1.0, 1.0, f"2024-01-{d:02d}") for d in range(1, 9) for i in range(20)]
    path = shared_dir(spark, "pruned")
    tables.write_partitioned(spark.createDataFrame(rows, FEATS).repartition(16), path)
    assert all(len(glob.glob(f"{d}/part-*")) == 1 for d in glob.glob(f"{path.removeprefix('file:')}/match_date=*"))
    table = files.read_table(spark, path, schemas.PLAYER_FEATURES)
    touched = tables.touched_partitions(table, spark.createDataFrame(rows[:3], FEATS))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-01" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert touched.count() == 20


def test_newest_row_without_a_sort_of_all_rows(spark, sf_dir):
    df = ball.latest_ball_state(ball.ball_flags(adapter.ball_rows(adapter.tracking(spark, sf_dir))))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    first_exchange = plan.split("Exchange")[-1]  # the deepest part of the tree
    assert "Sort" not in first_exchange and "HashAggregate" in plan


def test_late_rows_can_be_had_and_frames_stay_exact(spark):
    import pandas as pd

    def rows(data):
        return pd.DataFrame([("m", ms, fi, 0.0, 0.0, "A", st, False, True) for ms, fi, st in data], columns=live.INPUT_COLUMNS)

    big = 2**53
    start = ("Alive", False, True, None, None, 0)
    out, state = live.step(rows([(10, big + 1, "Dead"), (10, big, "Alive")]), start)
    assert [(r.frame_idx, r.new_value) for r in out.itertuples()] == [(big + 1, "Dead")] and state[4] == big + 1
    late, after = live.step(rows([(5, 1, "Alive"), (10, big + 1, "Dead")]), state, late_rows=True)
    assert list(late["kind"]) == ["LATE_ROW"] * 2 and list(late["wall_ms"]) == [5, 10] and after[5] == 2
    assert len(live.step(rows([(5, 1, "Alive")]), state)[0]) == 0


def test_no_private_folder_on_a_cluster():
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_base(Session())


def test_unreadable_paths_are_errors_not_absences(spark):
    with pytest.raises(Exception, match="nosuchscheme"):
        files.path_exists(spark, "nosuchscheme://x/y")
    assert not files.path_exists(spark, os.path.join(checkpoint_base(spark), "not-there"))
