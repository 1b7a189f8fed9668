"""Leaderboards and samples over the player feature table.

``row_number() <= n`` over a window is planned by Spark as a ``WindowGroupLimit``
that keeps only the top ``n`` rows per group inside every map task before the
shuffle, so even a group as large as a third of the table ships ``n`` rows per
task. Ties are broken by ``player_id`` (the reference relied on a sort before
the window, which the shuffle does not keep).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_N = 5
SAMPLE_N = 10


def leaderboard(
    features: DataFrame,
    n: int = TOP_N,
    ascending: bool = False,
    by: Sequence[str] = ("side", "match_date"),
    metric: str = "player_avg_speed",
) -> DataFrame:
    """The ``n`` fastest (or slowest) players per group, with their rank."""
    value = F.col(metric).asc_nulls_last() if ascending else F.col(metric).desc_nulls_last()
    w = Window.partitionBy(*by).orderBy(value, F.col("player_id").asc(), *[
        F.col(c).asc() for c in ("side", "match_date") if c not in by and c in features.columns
    ])
    return features.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_players(features: DataFrame, n: int = TOP_N) -> DataFrame:
    return leaderboard(features, n, ascending=False)


def bottom_players(features: DataFrame, n: int = TOP_N) -> DataFrame:
    return leaderboard(features, n, ascending=True)


def top_players_overall(features: DataFrame, n: int = TOP_N) -> DataFrame:
    """Fastest per side across all matches (the reference's unused team window)."""
    return leaderboard(features, n, ascending=False, by=("side",))


def side_report(features: DataFrame, side: str = "home") -> DataFrame:
    return features.where(F.col("side") == F.lit(side))


def sample_players(features: DataFrame, n: int = SAMPLE_N, seed: str = "0") -> DataFrame:
    """A repeatable sample of ``n`` feature rows per side.

    Rows are ranked by an MD5 of their key and a seed, which any engine computes
    the same way, so the sample is stable across runs and checkable.
    """
    digest = F.md5(F.concat_ws("|", F.col("player_id"), F.col("match_date"), F.lit(seed)))
    w = Window.partitionBy("side").orderBy(digest)
    return (
        features.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n)
    )
