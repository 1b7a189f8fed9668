"""Feature tables on files: partitioned overwrite, insert-only merge, upsert,
an incremental-load gate and an as-of lookup.

The reference uses Delta ``MERGE ... WHEN NOT MATCHED INSERT``. Plain Parquet
tables reject ``MERGE``, so the same effect is built from joins:

* insert-only merge: ``left_anti`` join of the new rows against the table's
  distinct keys, then append. Only key columns of the partitions that the new rows
  touch are read;
* upsert: rows of the touched partitions whose key is not in the new rows, plus
  the new rows, written with dynamic partition overwrite. Both are first
  checkpointed to the shared checkpoint folder so the write does not read the
  partitions it replaces. Two new rows with one key are an error;
* incremental gate: matches whose key is absent from the table (anti join on
  the partition column), replacing the reference's directory-name check.

Keys compare null-safe: a null is a value, so a re-run does not insert it again.
Writes are clustered by match (``rebalance``), so a match is a few files, and a
large match is several tasks' work.

Without Delta these writes are not atomic; concurrent writers are out of scope.
With ``fmt="delta"`` (jar present) the same calls write Delta files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.joins import join_lookup
from touchline.session import checkpoint_base
from touchline.sources.files import TABLE_FORMAT, path_exists, read_table

PARTITION = "match_date"


#: Beyond so many touched partitions a merge reads the key columns of the whole table.
PRUNE_PARTITIONS = 10_000


def write_partitioned(df: DataFrame, path: str, partition_by: str = PARTITION,
                      fmt: str = TABLE_FORMAT, mode: str = "overwrite") -> None:
    """Write partitioned by match. With the session's dynamic partition overwrite
    mode, ``overwrite`` replaces only the partitions present in ``df``.

    Rows are rebalanced by match first: adaptive execution puts small matches
    together and splits large ones, so files follow the data's size, not the tasks."""
    clustered = df.hint("rebalance", F.col(partition_by))
    clustered.write.format(fmt).mode(mode).partitionBy(partition_by).save(path)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join in which null keys equal each other."""
    other = right.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(other[f"__k_{k}"])
    return left.join(other, condition, how)


def touched_partitions(table: DataFrame, source: DataFrame, partition_by: str = PARTITION) -> DataFrame:
    """The rows of ``table`` in the partitions that ``source`` has rows of.

    The partition values (one per match of the load) become a filter that the scan
    prunes by; a load of very many matches uses a semi join instead, with the same rows.
    """
    values = source.select(partition_by).distinct()
    some = [r[0] for r in values.limit(PRUNE_PARTITIONS + 1).collect()]
    if len(some) > PRUNE_PARTITIONS:
        return null_safe_join(table, values, [partition_by], "left_semi")
    known = [v for v in some if v is not None]
    wanted = F.col(partition_by).isin(known)
    return table.where(wanted | F.col(partition_by).isNull() if len(known) < len(some) else wanted)


def merge_insert_only(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                      partition_by: str = PARTITION, fmt: str = TABLE_FORMAT,
                      schema: T.StructType | None = None, repeated_keys: bool = False) -> None:
    """Insert the rows of ``source`` whose key is not yet in the table at ``path``;
    bootstrap the table when it does not exist. Of several rows of one key in ``source``
    the first by its other columns, in their order, is inserted (:func:`first_per_key`);
    with ``repeated_keys`` all of them are, for keys that name a group of rows."""
    if not repeated_keys:
        source = first_per_key(source, keys)
    if not path_exists(spark, path):
        write_partitioned(source, path, partition_by, fmt)
        return
    existing = touched_partitions(read_table(spark, path, schema, fmt), source, partition_by).select(*keys).distinct()
    write_partitioned(null_safe_join(source, existing, keys, "left_anti"), path, partition_by, fmt, mode="append")


def first_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key (null is a value): the least by the other columns in their order,
    nulls first. The choice does not depend on files, partitions or earlier runs."""
    others = [c for c in source.columns if c not in keys]
    if not others:
        return source.distinct()
    least = source.groupBy(*keys).agg(F.min(F.struct(*others)).alias("__row"))
    return least.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in source.columns])


def _one_row_per_key(source: DataFrame, keys: Sequence[str]) -> None:
    twice = source.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"the source holds {twice[0]['count']} rows for one key: {twice[0].asDict()}")


def upsert_by_key(spark: SparkSession, source: DataFrame, path: str, keys: Sequence[str],
                  partition_by: str = PARTITION, fmt: str = TABLE_FORMAT,
                  schema: T.StructType | None = None) -> None:
    """Insert new keys and replace the rows of existing keys with ``source``'s.

    Raises ValueError when ``source`` holds a key twice: which row wins is the caller's to say."""
    checkpoint_base(spark)
    # Reliable checkpoints in the cluster's shared checkpoint folder: the source is
    # evaluated once, and the rows kept from the touched partitions no longer depend
    # on the files the overwrite replaces.
    src = source.checkpoint(eager=True)
    _one_row_per_key(src, keys)
    if not path_exists(spark, path):
        write_partitioned(src, path, partition_by, fmt)
        return
    current = read_table(spark, path, schema, fmt)
    src = src.select(*current.columns)
    kept = null_safe_join(touched_partitions(current, src, partition_by), src, keys, "left_anti").checkpoint(eager=True)
    write_partitioned(kept.unionByName(src), path, partition_by, fmt, mode="overwrite")


def new_keys(spark: SparkSession, candidates: DataFrame, path: str, key: str = PARTITION,
             fmt: str = TABLE_FORMAT, schema: T.StructType | None = None) -> DataFrame:
    """Distinct keys of ``candidates`` not yet stored in the table at ``path``."""
    keys = candidates.select(key).distinct()
    if not path_exists(spark, path):
        return keys
    stored = read_table(spark, path, schema, fmt).select(key).distinct()
    return null_safe_join(keys, stored, [key], "left_anti")


def incremental_load(spark: SparkSession, rows: DataFrame, path: str,
                     build: Callable[[DataFrame], DataFrame], key: str = PARTITION,
                     fmt: str = TABLE_FORMAT, schema: T.StructType | None = None) -> DataFrame:
    """Build and append features only for matches not yet in the table.

    ``rows`` are the input rows with a ``key`` column; ``build`` turns rows into
    table rows. Matches already stored are skipped before any work is done on
    them (semi join on the new keys). Returns the keys that were loaded: one row
    per new match, checkpointed (shared checkpoint folder) before the write so
    the answer does not change once the table has grown.
    """
    checkpoint_base(spark)
    todo = new_keys(spark, rows, path, key, fmt, schema).checkpoint(eager=True)
    fresh = build(null_safe_join(rows, todo, [key], "left_semi"))
    write_partitioned(fresh, path, key, fmt, mode="append")
    return todo


def features_as_of(features: DataFrame, cutoff: str, keys: Sequence[str] = ("side", "player_id"),
                   time_col: str = PARTITION, days: DataFrame | None = None) -> DataFrame:
    """Latest feature row per key by ``cutoff`` (a day as text); ``max_by`` is partial.

    Without ``days`` the match ids are days themselves: a filter on the partition column,
    which prunes partitions at the scan. Other ids say nothing of their day, so a table
    that holds any needs ``days`` (``match_id``, ``kickoff``, as the match metadata has
    them): a match's day is then its kick-off's, or its id where that is a day. An id
    without a day is an error, not a row left out."""
    value_cols = [c for c in features.columns if c not in keys]
    named = F.col(time_col)
    if days is None:
        rows = features.where((named <= F.lit(cutoff)) | F.try_to_date(named, "yyyy-MM-dd").isNull())
        day = F.try_to_date(named, "yyyy-MM-dd")
    else:
        lookup = days.groupBy(F.col("match_id").alias(time_col)).agg(F.min(F.to_date("kickoff")).alias("__day"))
        rows = join_lookup(features, lookup, [time_col], how="left")
        day = F.coalesce(F.col("__day"), F.try_to_date(named, "yyyy-MM-dd"))
    placed = F.when(day.isNull(), F.raise_error(F.concat(F.lit("match without a day: "), F.coalesce(named, F.lit("null")))).cast("date")).otherwise(day)
    rows = rows.withColumn("__at", placed).where(F.col("__at") <= F.lit(cutoff).cast("date"))
    # Two matches of a day: the larger id counts.
    latest = F.max_by(F.struct(*value_cols), F.struct("__at", named))
    return rows.groupBy(*keys).agg(latest.alias("f")).select(*keys, *[F.col(f"f.{c}").alias(c) for c in value_cols])
