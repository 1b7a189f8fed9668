"""Point-in-time join: for every request row, the newest feature row of its key by then.

Each request has its own time, so one cutoff for all (``features_as_of``) does not do.
Requests and features are laid on one time line per key, and a request takes the last
feature row before it. The time line is split into slots (:mod:`touchline.operators.sequence`):
a window sees one slot of one key, and one row per slot carries the newest feature on to
later slots, so no key's requests meet in one task. Where one slot of a key still is too
large, ``salts`` deals its requests over copies of the key's (few) feature rows.

Every request row comes back exactly once, repeated ones too. Where a key has several
feature rows of one time, the one with the largest values counts (columns compared in
their order). A request without a time or with a null key part has no feature; a feature
without a time is in no order and never found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.sequence import time_slot, with_previous


def as_of_join(
    requests: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    request_time: str,
    feature_time: str,
    slot_width: float,
    inclusive: bool = True,
    salts: int = 1,
) -> DataFrame:
    """``requests`` with the columns of ``features`` that they do not have.

    Times are numbers of one unit, and so is ``slot_width``. With ``inclusive`` a feature
    of the request's own time counts; without, only earlier ones (no look at the result of
    the very match that is asked for). All requests stay; feature columns are null where
    there is none."""
    keys = list(keys)
    values = [c for c in features.columns if c not in keys]
    added = [c for c in values if c not in requests.columns]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    key = F.struct(*keys).alias("_key")

    newest = features.where(known & F.col(feature_time).isNotNull()).groupBy(*keys, F.col(feature_time).alias("_t")).agg(
        F.max(F.struct(*values)).alias("_f"))
    # A feature comes before a request of its time, or after it.
    marks = newest.select(key, "_t", F.lit(0 if inclusive else 2).alias("_side"), F.lit(None).cast(requests.schema).alias("_r"),
                          "_f", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    # All columns, so that requests of one instant are dealt, too; repeated rows stay together.
    salt = F.pmod(F.xxhash64(F.to_json(F.struct(*requests.columns))), F.lit(salts)).cast("int") if salts > 1 else F.lit(0)
    asked = requests.select(key, F.col(request_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*requests.columns).alias("_r"),
                            F.lit(None).cast(newest.schema["_f"].dataType).alias("_f"), salt.alias("_salt"))
    line = asked.unionByName(marks)
    found = with_previous(line, ["_key", "_salt"], ["_t", "_side"], time_slot("_t", slot_width), ["_f"], ignore_nulls=True)
    answers = found.where("_side = 1")
    answered = F.when(F.col("_t").isNotNull(), F.col("prev__f"))
    return answers.select("_r.*", *[answered[c].alias(c) for c in added])
