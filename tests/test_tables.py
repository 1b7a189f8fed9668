"""Insert-only merge, upsert and the incremental gate on Parquet tables."""

from __future__ import annotations

from touchline import schemas
from touchline.operators import tables
from touchline.session import shared_dir
from touchline.sources import files

COLS = "side string, player_id string, player_avg_speed double, player_max_speed double, " \
       "maximum_speed_x double, match_date string"
KEYS = ["match_date", "side", "player_id"]


def _feats(spark, rows):
    return spark.createDataFrame(rows, COLS)


def _read(spark, path):
    return sorted(files.read_table(spark, path, schemas.PLAYER_FEATURES).collect())


def test_merge_twice_equals_merge_once(spark):
    path = shared_dir(spark, "merge-test")
    first = _feats(spark, [("home", "p1", 1.0, 2.0, 3.0, "2024-01-01")])
    both = _feats(spark, [("home", "p1", 9.0, 9.0, 9.0, "2024-01-01"), ("away", "p2", 1.0, 1.0, 1.0, "2024-01-02")])
    tables.merge_insert_only(spark, first, path, KEYS, schema=schemas.PLAYER_FEATURES)
    tables.merge_insert_only(spark, both, path, KEYS, schema=schemas.PLAYER_FEATURES)
    once = _read(spark, path)
    tables.merge_insert_only(spark, both, path, KEYS, schema=schemas.PLAYER_FEATURES)
    assert _read(spark, path) == once
    # Insert-only: the existing key keeps its first values.
    assert {(r.player_id, r.player_avg_speed) for r in once} == {("p1", 1.0), ("p2", 1.0)}


def test_upsert_replaces_and_keeps_other_partitions(spark):
    path = shared_dir(spark, "upsert-test")
    base = _feats(spark, [("home", "p1", 1.0, 1.0, 1.0, "2024-01-01"), ("home", "p3", 4.0, 4.0, 4.0, "2024-01-01"),
                          ("away", "p2", 1.0, 1.0, 1.0, "2024-01-02")])
    tables.upsert_by_key(spark, base, path, KEYS, schema=schemas.PLAYER_FEATURES)
    tables.upsert_by_key(spark, _feats(spark, [("home", "p1", 7.0, 7.0, 7.0, "2024-01-01")]), path, KEYS,
                         schema=schemas.PLAYER_FEATURES)
    got = {(r.match_date, r.player_id): r.player_avg_speed for r in _read(spark, path)}
    assert got == {("2024-01-01", "p1"): 7.0, ("2024-01-01", "p3"): 4.0, ("2024-01-02", "p2"): 1.0}


def test_incremental_gate_skips_stored_matches(spark):
    path = shared_dir(spark, "incremental-test")
    rows = _feats(spark, [("home", "p1", 1.0, 1.0, 1.0, "2024-01-01"), ("home", "p1", 2.0, 2.0, 2.0, "2024-01-02")])
    def build(df):
        return df

    tables.incremental_load(spark, rows.where("match_date = '2024-01-01'"), path, build, schema=schemas.PLAYER_FEATURES)
    added = tables.incremental_load(spark, rows, path, build, schema=schemas.PLAYER_FEATURES)
    assert [r.match_date for r in added.collect()] == ["2024-01-02"]
    assert len(_read(spark, path)) == 2
