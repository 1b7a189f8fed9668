"""The bucketed previous-row operator equals a plain window, buckets or not."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators.sequence import with_previous


def _rows(seed: int, n: int = 400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = rnd.choice(["a", "b", "c", None])
        t = rnd.randint(0, 900)
        v = None if rnd.random() < 0.25 else rnd.choice(["x", "y", "z"])
        rows.append((key, t, i, v))
    return rows


def test_matches_plain_lag_and_last_non_null(spark):
    df = spark.createDataFrame(_rows(7), "k string, t long, i long, v string")
    bucket = F.floor(F.col("t") / F.lit(60))
    got = with_previous(df, ["k"], ["t", "i"], bucket, ["v"])
    got_nn = with_previous(df, ["k"], ["t", "i"], bucket, ["v"], prefix="nn_", ignore_nulls=True)
    w = Window.partitionBy("k").orderBy("t", "i")
    want = df.select(
        "i",
        F.lag("v").over(w).alias("prev_v"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("nn_v"),
    )
    a = {r.i: r.prev_v for r in got.collect()}
    b = {r.i: r.nn_v for r in got_nn.collect()}
    expected = {r.i: (r.prev_v, r.nn_v) for r in want.collect()}
    assert len(a) == len(expected) == 400
    assert all(a[i] == expected[i][0] for i in expected)
    assert all(b[i] == expected[i][1] for i in expected)


def test_one_hot_key_spread_over_buckets(spark):
    # One key holding every row: the result must not depend on bucket width.
    rows = [("hot", t, t, float(t % 7)) for t in range(0, 5000, 3)]
    df = spark.createDataFrame(rows, "k string, t long, i long, v double")
    narrow = with_previous(df, ["k"], ["t", "i"], F.floor(F.col("t") / F.lit(10)), ["v"])
    wide = with_previous(df, ["k"], ["t", "i"], F.lit(0), ["v"])
    assert sorted(narrow.collect()) == sorted(wide.collect())
    assert narrow.where(F.col("prev_v").isNull()).count() == 1


def test_deep_recursion_with_small_fanout(spark):
    # Tiny buckets and fanout force several bucketed levels above the rows.
    df = spark.createDataFrame(_rows(11, 600), "k string, t long, i long, v string")
    bucket = F.floor(F.col("t") / F.lit(7))
    w = Window.partitionBy("k").orderBy("t", "i")
    want = {
        r.i: (r.a, r.b)
        for r in df.select(
            "i",
            F.lag("v").over(w).alias("a"),
            F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("b"),
        ).collect()
    }
    lag = with_previous(df, ["k"], ["t", "i"], bucket, ["v"], levels=3, fanout=2)
    nn = with_previous(df, ["k"], ["t", "i"], bucket, ["v"], ignore_nulls=True, levels=3, fanout=2)
    got_lag = {r.i: r.prev_v for r in lag.collect()}
    got_nn = {r.i: r.prev_v for r in nn.collect()}
    assert len(got_lag) == len(got_nn) == 600
    assert all(got_lag[i] == want[i][0] for i in want)
    assert all(got_nn[i] == want[i][1] for i in want)


def test_hot_key_with_default_frame_buckets(spark):
    """One key, 200,000 frames across four 65,536-frame buckets, with nulls: the
    bucketed result equals the plain window, and the big window is keyed by
    (key, bucket), not by the key alone."""
    from touchline.operators.sequence import frame_bucket

    df = spark.range(0, 200_000).select(
        F.lit("hot").alias("k"),
        F.col("id").alias("frame_idx"),
        (F.col("id") * F.lit(0.04)).alias("t"),
        F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("v"),
    )
    got = with_previous(df, ["k"], ["t", "frame_idx"], frame_bucket(), ["v"], ignore_nulls=True)
    w = Window.partitionBy("k").orderBy("t", "frame_idx")
    want = df.select(
        "frame_idx", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("w")
    )
    diff = got.join(want, "frame_idx").where(~F.col("prev_v").eqNullSafe(F.col("w")))
    assert got.count() == 200_000 and diff.count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__s0_id" in plan
