"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_lookup(big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a per-key lookup table (e.g. match metadata) onto a large table.

    No hint and no count: Spark broadcasts the lookup while its size in bytes is below
    ``spark.sql.autoBroadcastJoinThreshold`` (adaptive execution uses the measured
    size) and otherwise shuffles both sides, splitting skewed keys.
    """
    return big.join(lookup, on=list(on), how=how)
