"""Bucketed tables: insert-only merge without a shuffle of the stored rows.

A table is dealt by its key into a fixed number of buckets when it is written. A later
load is shuffled to the same buckets, so the anti join reads each bucket of the table
where it lies: what moves is the load, however large the table has grown.

Use it for loads that touch keys all over a table. A load of a few matches does better
with ``tables.merge_insert_only``, which reads only their partitions; a bucketed table
has no partition folders, and a merge reads the key columns of all of it.

Spark keeps a table's buckets in its catalog, which may last no longer than the session.
So the buckets are part of the folder's name, and the table is declared again by whoever
opens it; opening it with another key or count is an error, not a wrong join.

Each load adds at most one file to a bucket. Writes are not atomic among writers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.tables import first_per_key, null_safe_join
from touchline.session import configure
from touchline.sources.files import TABLE_FORMAT, path_exists

#: Buckets of a table unless told otherwise; about 1 GB of stored rows each is a good size.
BUCKETS = 64


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def open_table(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
               buckets: int = BUCKETS) -> str:
    """Declare the table under ``path`` in the session's catalog and return its name.

    The folder is made by the first merge. ValueError where ``path`` holds a table with
    other keys or another number of buckets."""
    configure(spark)
    location = f"{path.rstrip('/')}/{buckets}-by-{'-'.join(keys)}"
    name = "bucketed_" + hashlib.sha256(location.encode()).hexdigest()[:24]
    if spark.catalog.tableExists(name):
        return name
    if path_exists(spark, path) and not path_exists(spark, location):
        raise ValueError(f"{path} holds no table of {buckets} buckets by {list(keys)}")
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(_quoted(k) for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {TABLE_FORMAT} "
              f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
              f"LOCATION '{location}'")
    return name


def unseen(source: DataFrame, stored: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """The rows of ``source`` whose key ``stored`` (bucketed by the keys) does not hold.

    Keys without a null meet by plain equality, the only form that Spark matches with
    buckets. Rows with a null in their key, on either side, meet null-safe beside them:
    a filter that reaches the scan, and few rows."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    held = stored.select(*keys)
    dealt = source.where(~has_null).repartition(buckets, *keys)
    plain = dealt.join(held.where(~has_null), list(keys), "left_anti").select(*source.columns)
    return plain.unionByName(null_safe_join(source.where(has_null), held.where(has_null), keys, "left_anti"))


def merge_insert_only(spark: SparkSession, source: DataFrame, path: str, schema: T.StructType,
                      keys: Sequence[str], buckets: int = BUCKETS) -> str:
    """Insert the rows of ``source`` whose key the table lacks, and return the table's name.

    Of several rows of one key the first by its other columns is inserted
    (``tables.first_per_key``); null is a key value; columns beyond ``schema`` are not
    stored. The same load again inserts nothing."""
    name = open_table(spark, path, schema, keys, buckets)
    typed = source.select(*[F.col(_quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
    fresh = unseen(first_per_key(typed, keys), spark.table(name), keys, buckets)
    # Dealt once more only where the join did not leave the rows in their buckets (the few with nulls).
    fresh.repartition(buckets, *keys).select(*schema.fieldNames()).write.insertInto(name)
    return name
