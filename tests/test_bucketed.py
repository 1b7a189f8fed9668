"""Insert-only merge into bucketed tables: no exchange above the stored rows, one row per key."""

from __future__ import annotations

import pytest

from touchline import schemas
from touchline.operators import bucketed
from touchline.session import shared_dir

COLS = "side string, player_id string, player_avg_speed double, player_max_speed double, " \
       "maximum_speed_x double, match_date string"
KEYS = ["match_date", "side", "player_id"]
SCHEMA = schemas.PLAYER_FEATURES


def _row(match, player, speed, side="home"):
    return (side, player, speed, speed, speed, match)


def _merge(spark, rows, path, buckets=4):
    return bucketed.merge_insert_only(spark, spark.createDataFrame(rows, COLS), path, SCHEMA, KEYS, buckets)


def _speeds(spark, name):
    rows = spark.table(name).collect()
    got = {(r.match_date, r.side, r.player_id): r.player_avg_speed for r in rows}
    assert len(got) == len(rows)
    return got


def test_keys_are_inserted_once_and_stay(spark):
    path = shared_dir(spark, "bucketed-test")
    name = _merge(spark, [_row("0012", f"p{i}", 1.0) for i in range(50)], path)
    load = [_row("0012", f"p{i}", 9.0) for i in range(60)] + [_row("0013", "p1", 5.0), _row("0013", "p1", 3.0)]
    for _ in range(2):
        assert _merge(spark, load, path) == name
    want = {("0012", "home", f"p{i}"): 1.0 if i < 50 else 9.0 for i in range(60)}
    assert _speeds(spark, name) == {**want, ("0013", "home", "p1"): 3.0}


def test_null_is_a_key_value(spark):
    path = shared_dir(spark, "bucketed-null")
    rows = [_row(None, "p1", 1.0), _row("0012", None, 2.0), _row("0012", "p1", None), _row(None, None, 4.0, None)]
    for _ in range(2):
        name = _merge(spark, rows, path)
    assert _speeds(spark, name) == {(m, s, p): v for s, p, v, _, _, m in rows}
    assert _merge(spark, [], path) == name
    assert spark.table(name).count() == 4


def test_empty_first_load_and_columns_beyond_the_schema(spark):
    path = shared_dir(spark, "bucketed-empty")
    name = _merge(spark, [], path)
    assert spark.table(name).count() == 0
    extra = spark.createDataFrame([_row("m", "p", 1.0) + ("x",)], COLS + ", __row string")
    bucketed.merge_insert_only(spark, extra, path, SCHEMA, KEYS, 4)
    assert spark.table(name).columns == SCHEMA.fieldNames()
    assert _speeds(spark, name) == {("m", "home", "p"): 1.0}


def test_opened_again_and_refused_with_other_buckets(spark):
    path = shared_dir(spark, "bucketed-open")
    name = _merge(spark, [_row("m", "p", 1.0)], path)
    # A later session has no catalog entry; the files stay when an outside table is dropped.
    spark.sql(f"DROP TABLE {name}")
    assert _merge(spark, [_row("m", "p", 2.0), _row("m", "q", 2.0)], path) == name
    assert _speeds(spark, name) == {("m", "home", "p"): 1.0, ("m", "home", "q"): 2.0}
    with pytest.raises(ValueError, match="8 buckets"):
        bucketed.open_table(spark, path, SCHEMA, KEYS, 8)


def test_stored_rows_are_not_shuffled(spark):
    path = shared_dir(spark, "bucketed-plan")
    name = _merge(spark, [_row("m", f"p{i}", 1.0) for i in range(200)], path)
    load = spark.createDataFrame([_row("m", f"p{i}", 1.0) for i in range(150, 250)], COLS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = bucketed.unseen(load.where("match_date is not null"), spark.table(name), KEYS, 4)
        plain = load.repartition(4, *KEYS).join(spark.table(name).select(*KEYS), KEYS, "left_anti")
        assert fresh.count() == 50 and plain.count() == 50
        for df, joins in ((fresh, 2), (plain, 1)):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
            assert plan.count("SortMergeJoin") <= joins
            # Of the bucketed scans, the one that meets the load's keys has no exchange above it.
            assert _exchanges_above_first_scan(plan) == 0, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _exchanges_above_first_scan(plan: str) -> int:
    """Exchanges between the first bucketed scan and the join above it, by the tree's indent."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and "Bucketed: true" in line)
    depth, found = _depth(lines[at]), 0
    for line in reversed(lines[:at]):
        if _depth(line) < depth:
            depth = _depth(line)
            if "Join" in line:
                return found
            found += "Exchange" in line
    raise AssertionError("no join above the scan")


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-*"))
