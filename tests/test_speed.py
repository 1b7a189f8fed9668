"""Speed features on hand-made tracking rows (FIXTURES F10)."""

from __future__ import annotations

from touchline.operators import ranking, speed

COLS = ("match_date string, wall_ms long, period int, frame_idx long, side string, player_id string, "
        "speed double, x double, y double, ball_status string, game_clock double")


def _df(spark, rows):
    full = [(m, 0, per, fi, side, pid, sp, x, 0.0, "Alive", gc) for (m, per, fi, side, pid, sp, x, gc) in rows]
    return spark.createDataFrame(full, COLS)


def _by_key(df, value):
    return {(r.match_date, r.side, r.player_id): r[value] for r in df.collect()}


def test_equal_clock_gives_null_not_error(spark):
    df = _df(spark, [("d1", 1, 1, "home", "p1", 1.0, 0.0, 10.0), ("d1", 1, 2, "home", "p1", 1.0, 5.0, 10.0)])
    rows = speed.frame_speed_x(df).collect()
    assert len(rows) == 1 and rows[0].speed_x is None
    assert _by_key(speed.max_speed_x(df), "maximum_speed_x") == {("d1", "home", "p1"): None}


def test_no_lag_across_periods_and_buckets_are_stitched(spark):
    rows = [
        ("d1", 1, 1, "home", "p1", 2.0, 0.0, 59.0),
        ("d1", 1, 2, "home", "p1", 4.0, 3.0, 61.0),   # next minute bucket: 3 m / 2 s
        ("d1", 2, 3, "home", "p1", 6.0, 50.0, 0.5),   # clock restarts in period 2
        ("d1", 2, 4, "home", "p1", 8.0, 50.5, 1.0),   # 0.5 m / 0.5 s
    ]
    df = _df(spark, rows)
    feats = speed.player_features(df).collect()[0]
    assert feats.maximum_speed_x == 1.5
    assert feats.player_avg_speed == 5.0 and feats.player_max_speed == 8.0
    per_frame = sorted((r.frame_idx, r.speed_x) for r in speed.frame_speed_x(df).collect())
    assert per_frame == [(2, 1.5), (4, 1.0)]


def test_first_frame_skipped_or_zero_filled(spark):
    df = _df(spark, [("d1", 1, 1, "away", "p2", 1.0, -20.0, 4.0)])
    assert _by_key(speed.max_speed_x(df), "maximum_speed_x") == {("d1", "away", "p2"): None}
    zero = speed.max_speed_x_zero_fill(df).collect()[0]
    assert zero.maximum_speed_x == 5.0  # |x| / t


def test_two_matches_and_both_sides_do_not_fan_out(spark):
    rows = [
        ("d1", 1, 1, "home", "p1", 1.0, 0.0, 1.0), ("d1", 1, 2, "home", "p1", 3.0, 1.0, 2.0),
        ("d2", 1, 3, "home", "p1", 5.0, 0.0, 1.0), ("d2", 1, 4, "away", "p1", 7.0, 2.0, 2.0),
    ]
    df = _df(spark, rows)
    perf = speed.player_performance(df)
    joined = speed.player_performance_join(df)
    assert perf.count() == joined.count() == 3
    assert sorted(perf.collect()) == sorted(joined.select(*perf.columns).collect())


def test_equal_averages_at_the_cut_ordered_by_player(spark):
    rows = [("d1", 1, i, "home", f"p{i}", 5.0, 0.0, float(i)) for i in range(1, 8)]
    top = ranking.top_players(speed.player_performance(_df(spark, rows)))
    assert [r.player_id for r in top.orderBy("rank").collect()] == ["p1", "p2", "p3", "p4", "p5"]
