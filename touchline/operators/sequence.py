"""Previous-row values over long ordered sequences, split so no group is whole.

``lag(c) OVER (PARTITION BY keys ORDER BY order)`` puts every row of one key into
one task. A player's or a match's sequence can be a large share of all rows, so
this operator splits each key's sequence into buckets. The library's buckets are
time slots, ``floor(clock / width)`` of the leading order column (:func:`time_slot`):
they rise with the order by construction, whatever the frame counter does, and a
key has a bounded number of rows per slot (25 frames a second). The width changes
the work per task, never the result.

1. one window per (keys, bucket) gives every row its previous row inside the
   bucket, and the bucket's first row also the bucket's last values;
2. the first rows (one per bucket) need the previous bucket's last values: a
   plain window per key over them, which sees one row per slot of the key. For
   still larger keys ``levels > 0`` runs the same operator on the first rows, bucketed by
   ``floor(bucket / fanout)``, each level ``fanout`` times smaller; every level
   costs one more (small) shuffle;
3. the other rows keep their in-bucket values; the parts are unioned.

With ``ignore_nulls`` the rows before a bucket's first non-null value (all of its
rows, where a signal stays null) take the value carried in from earlier buckets.
Only one summary row per bucket goes into the window per key; its answer is spread
over the bucket's rows by a window per (keys, bucket).

All branches of a level read the same shuffle (Spark reuses the exchange), so
the rows are scanned and shuffled once; each further level moves a table
``fanout`` times smaller than the one below.

The bucket column must be numeric and non-decreasing along ``order`` within a key
(a time slot of the first order column is), and ``order`` must be a total order
within a key (add a unique tie-breaker). With ``ignore_nulls`` the columns must be
orderable (the single carried value of a bucket is picked with ``max``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FRAMES_PER_BUCKET = 65536
FANOUT = 1024
LEVELS = 0

#: Default slot width: an hour of 25 Hz tracking is 90,000 rows of one key.
SLOT_SECONDS = 3600.0


def time_slot(clock: str | Column, width: float) -> Column:
    """The bucket of a clock value: ``floor(clock / width)``, in the clock's own unit.

    Rows without a clock have a null slot, ordered before all others; callers that
    cannot order such rows take them out first."""
    clock = F.col(clock) if isinstance(clock, str) else clock
    return F.floor(clock / F.lit(width))


def frame_bucket(frame_col: str = "frame_idx", frames: int = FRAMES_PER_BUCKET) -> Column:
    """Runs of ``frames`` frame numbers, for sequences ordered by that very column."""
    return F.floor(F.col(frame_col) / F.lit(frames))


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _plain(df: DataFrame, keys, order, cols, prefix, ignore_nulls) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    for c in cols:
        prev = F.last(c, ignorenulls=True).over(before) if ignore_nulls else F.lag(c).over(w)
        df = df.withColumn(prefix + c, prev)
    return df


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    bucket: Column | None,
    cols: Sequence[str],
    prefix: str = "prev_",
    ignore_nulls: bool = False,
    levels: int = LEVELS,
    fanout: int = FANOUT,
) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the key.

    With ``ignore_nulls`` it is the last non-null value before the row instead.
    Null keys form their own sequence, as in a window. ``bucket=None`` or
    ``levels < 0`` gives the plain window. Output rows are not partitioned by key.
    """
    keys, order, cols = list(keys), list(order), list(cols)
    if bucket is None or levels < 0:
        return _plain(df, keys, order, cols, prefix, ignore_nulls)

    n = f"__s{levels}"  # internal names, unique per level
    sid, b, first, t = f"{n}_id", f"{n}_b", f"{n}_first", f"{n}_t_"
    out_cols = list(df.columns) + [prefix + c for c in cols]
    # (keys, bucket) as one struct column: one hash partitioning for the window.
    # The bucket lives only inside the struct, so every branch below projects the
    # same columns under the exchange and Spark reuses it.
    rows = df.withColumn(sid, F.struct(*[F.col(k) for k in keys], bucket.alias(b)))
    b_col = F.col(f"{sid}.{b}").alias(b)
    w_in = Window.partitionBy(sid).orderBy(*_cols(order))
    before = w_in.rowsBetween(Window.unboundedPreceding, -1)
    whole = w_in.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    rows = rows.withColumn(first, F.lag(F.lit(1)).over(w_in).isNull())
    for c in cols:
        if ignore_nulls:
            rows = rows.withColumn(prefix + c, F.last(c, ignorenulls=True).over(before))
        else:
            rows = rows.withColumn(prefix + c, F.lag(c).over(w_in))
        # The bucket's last (non-null) value, for the buckets after it.
        rows = rows.withColumn(t + c, F.last(c, ignorenulls=ignore_nulls).over(whole))

    upper = F.floor(F.col(b) / F.lit(fanout)) if levels > 0 else None
    t_cols = [t + c for c in cols]

    if not ignore_nulls:
        inner = rows.where(~F.col(first)).select(*out_cols)
        heads = rows.where(F.col(first)).select(*df.columns, b_col, *t_cols)
        heads = with_previous(heads, keys, [b], upper, t_cols, prefix="p", levels=levels - 1, fanout=fanout)
        firsts = heads.select(*df.columns, *[F.col("p" + t + c).alias(prefix + c) for c in cols])
        return inner.unionByName(firsts)

    # Rows before a bucket's first non-null value ("lead" rows) take the value carried
    # in from earlier buckets. One head row per bucket fetches it (a window per key over
    # heads alone) and hands it to the bucket's lead rows.
    needs = F.lit(False)
    for c in cols:
        needs = needs | F.col(prefix + c).isNull()
    inner = rows.where(~needs).select(*out_cols)
    is_head, carry = f"{n}_head", f"{n}_carry_"
    # Heads keep all columns, so that every branch has the same ones under the exchange.
    heads = rows.where(F.col(first)).select(*out_cols, sid, b_col, *t_cols)
    heads = with_previous(heads, keys, [b], upper, t_cols, prefix="p", ignore_nulls=True, levels=levels - 1, fanout=fanout)
    heads = heads.select(*out_cols, sid, F.lit(True).alias(is_head), *[F.col("p" + t + c).alias(carry + c) for c in cols])
    lead = rows.where(needs).select(*out_cols, sid, F.lit(False).alias(is_head))
    both = lead.unionByName(heads, allowMissingColumns=True)
    per_bucket = Window.partitionBy(sid)
    for c in cols:
        both = both.withColumn(carry + c, F.max(carry + c).over(per_bucket))
    lead = both.where(~F.col(is_head)).select(
        *df.columns, *[F.coalesce(F.col(prefix + c), F.col(carry + c)).alias(prefix + c) for c in cols])
    return inner.unionByName(lead)
