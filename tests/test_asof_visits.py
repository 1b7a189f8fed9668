"""Point-in-time join and visits against plain Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from touchline.operators import asof, visits

REQ = "id long, p string, t long, v string"
FEAT = "p string, ft long, a double, b string"


def brute_as_of(requests, features, inclusive):
    out = []
    for r in requests:
        ok = [f for f in features if r[1] is not None and r[2] is not None and f[0] == r[1] and f[1] is not None
              and (f[1] <= r[2] if inclusive else f[1] < r[2])]
        best = max(ok, key=lambda f: (f[1], f[2], f[3])) if ok else None
        out.append((*r, *((best[1], best[2], best[3]) if best else (None, None, None))))
    return Counter(out)


@pytest.mark.parametrize("inclusive,width,salts", [(True, 10, 1), (False, 10, 1), (True, 1, 3), (False, 1000, 5)])
def test_as_of_join_against_brute_force(spark, inclusive, width, salts):
    rng = random.Random(width + salts)
    hot = lambda: "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
    requests = [(i, hot(), rng.choice([None, *range(-30, 60)]), "x") for i in range(500)]
    requests += requests[:40]  # repeated rows each get their answer
    features = [(hot(), rng.choice([None, *range(-20, 50)]), float(rng.randint(0, 9)), rng.choice("xyz")) for i in range(120)]  # ties among them
    got = asof.as_of_join(spark.createDataFrame(requests, REQ), spark.createDataFrame(features, FEAT), ["p"], "t", "ft", width, inclusive, salts)
    assert got.columns == ["id", "p", "t", "v", "ft", "a", "b"]
    assert Counter(tuple(r) for r in got.collect()) == brute_as_of(requests, features, inclusive)


def test_as_of_join_without_features_or_requests(spark):
    requests, features = spark.createDataFrame([(1, "a", 5, "x")], REQ), spark.createDataFrame([("a", 1, 2.0, "x")], FEAT)
    none = asof.as_of_join(requests, features.limit(0), ["p"], "t", "ft", 10)
    assert [tuple(r) for r in none.collect()] == [(1, "a", 5, "x", None, None, None)]
    assert asof.as_of_join(requests.limit(0), features, ["p"], "t", "ft", 10).collect() == []


def test_as_of_join_splits_a_hot_player(spark):
    """A player's requests go to as many groups as there are slots and salts."""
    requests = spark.range(20_000).select(F.col("id"), F.lit("hot").alias("p"), F.pmod("id", F.lit(1000)).alias("t"), F.lit("x").alias("v"))
    features = spark.range(0, 1000, 10).select(F.lit("hot").alias("p"), F.col("id").alias("ft"), F.col("id").cast("double").alias("a"), F.lit("b").alias("b"))
    got = asof.as_of_join(requests, features, ["p"], "t", "ft", 50, salts=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    wrong = got.where("ft IS DISTINCT FROM t - pmod(t, 10)")
    assert got.count() == 20_000 and wrong.count() == 0


ROWS = "match_id string, wall_ms long, frame_idx long, in_box boolean"


def brute_visits(rows):
    by = defaultdict(list)
    for m, w, f, b in rows:
        if b is not None and w is not None:
            by[m].append((w, f, b))
    out = []
    for m, seq in by.items():
        run = []
        for w, _f, b in [*sorted(seq), (0, 0, False)]:
            if b:
                run.append(w)
            elif run:
                out.append((m, run[0], run[-1], (run[-1] - run[0]) / 1000.0, len(run)))
                run = []
    return sorted(out)


@pytest.mark.parametrize("p_stay,slot", [(0.5, 0.01), (0.5, 5.0), (0.97, 0.02), (0.97, 0.5), (0.999, 0.05), (0.97, 3600.0)])
def test_visits_against_plain_islands(spark, p_stay, slot):
    """Short and very long visits, empty slots between rows, visits over many slots."""
    rng, rows, inside = random.Random(int(p_stay * 1000 + slot)), [], False
    for m in ("m1", "m2"):
        clock = -500
        for i in range(700):
            clock += rng.choice([0, 0, 7, 40, 900])
            inside = inside if rng.random() < p_stay else not inside
            rows.append((m, clock, i, None if rng.random() < 0.05 else inside))
    rows += [("m1", None, 1, True), ("m3", 5, 1, False), ("m4", 5, 1, True)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = visits.visits(spark.createDataFrame(shuffled, ROWS), slot_seconds=slot)
    assert sorted(tuple(r) for r in got.collect()) == brute_visits(rows)


def test_visits_join_at_most_two_rows_a_slot(spark):
    rows = [("m", i * 10, i, i % 2 == 0) for i in range(5000)]  # the flag turns at every row
    runs = visits.slot_runs(spark.createDataFrame(rows, ROWS), slot_seconds=1.0)
    edges = runs.where("run = 1 OR run = last_run").groupBy("slot").count()
    assert runs.count() == 5000 and edges.agg({"count": "max"}).first()[0] == 2 and edges.count() == 50


def test_no_rows(spark):
    assert visits.visits(spark.createDataFrame([], ROWS)).collect() == []
