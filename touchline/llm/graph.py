"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import stage


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, component`` for each node of ``edges`` (columns a, b: longs) that is not
    its component's smallest node; the smallest node itself has no row.

    Every round points nodes at smaller ones: minima are partial aggregates, and the
    joins that follow read written tables, so a hub's edges can be split over tasks.
    Null ends and loops are ignored; repeated edges count once.
    """
    e = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = stage(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    before = None
    for _ in range(max_rounds):
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m")), "cc-low")
        large = both.join(low, F.col("u") == F.col("_u")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.distinct(), "cc-large")
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), "m"), "cc-low")
        small = large.join(low, F.col("u") == F.col("_u")).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(low.select(F.col("_u").alias("u"), F.col("m").alias("v"))).distinct(), "cc-edges")
    raise RuntimeError("components did not settle")
