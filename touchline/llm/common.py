"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import shared_dir

#: White space that separates words: blank and the control characters 9 to 13.
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder below the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor sees; a lost executor costs a
    re-read of these files, not a new run of what made them.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows and bytes of one Arrow batch between the JVM and Python. Rows here are whole
#: texts; Spark's default of 10,000 rows a batch would hold tens of megabytes several times.
ARROW_ROWS, ARROW_BYTES = 1000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches for operators that pass texts to Python."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def give_back() -> None:
    """Return freed memory to the system. Spark keeps a Python worker for later tasks, and
    what an earlier one has freed would count against the executor for as long."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: bounds what a task holds as Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    give_back()


def text_or_empty(text="text"):
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text):
    """A-Z to a-z and nothing else (``lower`` would also map other alphabets)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def space_words(text):
    """Array of the maximal runs without white space."""
    return F.array_remove(F.split(text, SPACE_CLASS), "")


def ordered_int(hex_text, digits: int = 13):
    """Leading hex digits of a digest as a long; the same rule is easy in any SQL."""
    return F.conv(F.substring(hex_text, 1, digits), 16, 10).cast("long")
