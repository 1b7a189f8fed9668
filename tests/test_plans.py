"""Physical plan shapes the scale design relies on (final adaptive plans)."""

from __future__ import annotations

import re

from touchline.plans.catalog import QUERIES


def _final_plan(spark, sf_dir, name) -> str:
    df = QUERIES[name](spark, sf_dir)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _final_part(plan: str) -> str:
    # The adaptive plan prints the final plan first, then the initial one.
    return plan.split("+- == Initial Plan ==")[0]


def test_player_features_one_big_exchange_and_pruned_scan(spark, sf_dir):
    plan = _final_part(_final_plan(spark, sf_dir, "player_performance"))
    assert plan.count("FileScan parquet") == 1
    scan = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert sorted(c.split("#")[0] for c in scan.split(",")) == ["event_id", "ts", "user_id", "value"]
    # rows by (match, side, player, period, bucket); buckets by (.., period); players.
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Join" not in plan


def test_live_events_reuse_one_shuffle(spark, sf_dir):
    plan = _final_part(_final_plan(spark, sf_dir, "live_events"))
    assert plan.count("FileScan parquet") == 1
    assert "ReusedExchange" in plan
    assert "Join" not in plan


def test_leaderboards_limit_before_shuffle(spark, sf_dir):
    for name in ("top_players", "bottom_players", "top_players_overall", "sample_players"):
        plan = _final_plan(spark, sf_dir, name)
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_area_filter_below_partial_aggregate(spark, sf_dir):
    df = QUERIES["ball_in_box_stats"](spark, sf_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    agg_at = plan.index("Aggregate")
    assert plan.index("Filter", agg_at) > agg_at  # the filter sits under the aggregate
