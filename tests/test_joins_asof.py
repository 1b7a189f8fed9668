"""Lookup joins without hints; as-of features."""

from __future__ import annotations

from touchline.operators import tables
from touchline.operators.joins import join_lookup


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_broadcast_is_left_to_the_size_threshold(spark):
    big = spark.range(0, 1000).selectExpr("id % 10 AS k", "id")
    small = spark.range(0, 10).selectExpr("id AS k", "id * 2 AS v")
    assert join_lookup(big, small, ["k"]).count() == 1000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = join_lookup(big, small, ["k"])
        assert "BroadcastHashJoin" not in _plan(plain)
        assert plain.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_features_as_of_takes_latest_before_cutoff(spark):
    rows = [
        ("home", "p1", 1.0, 1.0, 1.0, "2024-01-01"),
        ("home", "p1", 2.0, 2.0, 2.0, "2024-01-05"),
        ("home", "p1", 3.0, 3.0, 3.0, "2024-01-09"),
        ("away", "p2", 4.0, 4.0, 4.0, "2024-01-10"),
    ]
    feats = spark.createDataFrame(rows, "side string, player_id string, player_avg_speed double, "
                                        "player_max_speed double, maximum_speed_x double, match_date string")
    got = tables.features_as_of(feats, "2024-01-06").collect()
    assert [(r.player_id, r.match_date, r.player_avg_speed) for r in got] == [("p1", "2024-01-05", 2.0)]
