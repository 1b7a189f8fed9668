"""Stored partial features: merged after late rows, equal to a rebuild."""

from __future__ import annotations

import random

import pytest

from touchline import schemas
from touchline.operators import partials, speed, tables
from touchline.plans import jobs
from touchline.session import shared_dir
from touchline.sources import files

COLS = "match_date string, side string, player_id string, period int, frame_idx long, game_clock double, x double, speed double"


def tracking(seed: int, n: int = 600):
    rng = random.Random(seed)
    return [("0012" if rng.random() < 0.7 else "M-2", rng.choice(["home", "away"]), rng.choice(["p1", "p2", None]), rng.choice([1, 2, None]), i,
             None if rng.random() < 0.05 else round(rng.random() * 1500, 2), None if rng.random() < 0.05 else float(rng.randint(-50, 50)),
             None if rng.random() < 0.1 else float(rng.randint(0, 90)) / 8) for i in range(n)]


def rows_of(df):
    return sorted(map(str, df.select("match_date", "side", "player_id", "player_avg_speed", "player_max_speed", "maximum_speed_x").collect()))


def parts_of(spark, path):
    return {tuple(r[k] for k in partials.SLOT_KEYS): r for r in files.read_table(spark, path, partials.SCHEMA).collect()}


def store(spark, paths, rows):
    late = spark.createDataFrame(rows, COLS)
    tables.write_partitioned(late, paths[0], mode="append")
    jobs.merge_late_features(spark, late, *paths)


@pytest.mark.parametrize("width", [20.0, 300.0, 5000.0])
def test_partials_merge_to_the_features_of_a_rebuild(spark, monkeypatch, width):
    monkeypatch.setattr(partials, "SLOT_SECONDS", width)
    df = spark.createDataFrame(tracking(1), COLS)
    assert rows_of(partials.features(partials.slot_partials(df))) == rows_of(speed.player_performance(df))


def test_late_rows_between_stored_ones(spark, monkeypatch):
    monkeypatch.setattr(partials, "SLOT_SECONDS", 50.0)
    rows = tracking(2)
    paths = [shared_dir(spark, n) for n in ("players", "partials", "features")]
    rng = random.Random(3)
    rng.shuffle(rows)
    for part in (rows[:400], rows[400:500], rows[500:501], rows[501:]):
        store(spark, paths, part)
    want = rows_of(speed.player_performance(spark.createDataFrame(rows, COLS)))
    assert rows_of(files.read_table(spark, paths[2], schemas.PLAYER_FEATURES)) == want
    jobs.merge_late_features(spark, spark.createDataFrame(rows[501:], COLS), *paths)  # a re-run changes nothing
    assert rows_of(files.read_table(spark, paths[2], schemas.PLAYER_FEATURES)) == want


def test_a_late_file_changes_only_its_slots(spark, monkeypatch):
    monkeypatch.setattr(partials, "SLOT_SECONDS", 50.0)
    paths = [shared_dir(spark, n) for n in ("players", "partials", "features")]
    store(spark, paths, tracking(4))
    before = parts_of(spark, paths[1])
    read = []
    original = partials.slot_partials
    monkeypatch.setattr(partials, "slot_partials", lambda rows: (read.append(rows.count()), original(rows))[1])
    store(spark, paths, [("0012", "home", "p1", 1, 9000, 120.5, 49.0, 99.0), ("0012", "home", "p1", 1, 9001, 1700.0, 0.0, 1.0)])
    after = parts_of(spark, paths[1])
    changed = {k for k in after if before.get(k) != after[k]}
    assert changed == {("0012", "home", "p1", 1, 2), ("0012", "home", "p1", 1, 34)} and set(before) <= set(after)
    in_slots = sum(r[:4] == ("0012", "home", "p1", 1) and r[5] is not None and 100 <= r[5] < 150 for r in tracking(4))
    assert read == [in_slots + 2]  # the rows of two slots, not those of the match


def test_a_new_match_and_a_new_player(spark):
    paths = [shared_dir(spark, n) for n in ("players", "partials", "features")]
    first, second = tracking(5, 100), [("new", "home", "p9", 1, i, i * 0.04, float(i), 2.0) for i in range(5)]
    store(spark, paths, first)
    store(spark, paths, second)
    got = rows_of(files.read_table(spark, paths[2], schemas.PLAYER_FEATURES))
    assert got == rows_of(speed.player_performance(spark.createDataFrame(first + second, COLS)))
