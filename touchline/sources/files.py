"""File sources and sinks: JSON-lines frames, XML match metadata, stored tables.

Reads always take an explicit schema. A partitioned table's ``match_date`` is
declared as text in the schema, so Spark does not infer it as a date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import schemas

TABLE_FORMAT = "parquet"


def read_frames(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    """JSON-lines frame records. With ``keep_corrupt`` unparseable lines are kept
    as rows with ``_corrupt_record`` set (PERMISSIVE mode) instead of nulls."""
    reader = spark.read.option("mode", "PERMISSIVE")
    if keep_corrupt:
        reader = reader.schema(schemas.FRAME_WITH_CORRUPT).option("columnNameOfCorruptRecord", schemas.CORRUPT)
    else:
        reader = reader.schema(schemas.FRAME_WITH_ID)
    return reader.json(path)


def write_frames(frames: DataFrame, path: str) -> None:
    frames.write.mode("overwrite").json(path)


def read_match_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``<match dtDate=.. fPitchXSizeMeters=.. fPitchYSizeMeters=..>`` elements →
    (match_id, kickoff, pitch_length, pitch_width); ``match_id`` is the element's
    ``matchId`` where it has one, else the kickoff's date."""
    raw = (
        spark.read.format("xml")
        .option("rowTag", "match")
        .schema(schemas.MATCH_METADATA)
        .load(path)
    )
    kickoff = F.try_to_timestamp(F.col("_dtDate"), F.lit("yyyy-MM-dd HH:mm:ss"))
    return raw.select(
        F.coalesce(F.col("_matchId"), F.date_format(kickoff, "yyyy-MM-dd")).alias("match_id"),
        kickoff.alias("kickoff"),
        F.col("_fPitchXSizeMeters").alias("pitch_length"),
        F.col("_fPitchYSizeMeters").alias("pitch_width"),
    )


def write_match_metadata(metadata: DataFrame, path: str) -> None:
    """Metadata rows (``dtDate``, ``fPitchXSizeMeters``, ``fPitchYSizeMeters``) as
    XML elements with attributes."""
    out = metadata.select(
        F.col("dtDate").alias("_dtDate"),
        F.col("fPitchXSizeMeters").alias("_fPitchXSizeMeters"),
        F.col("fPitchYSizeMeters").alias("_fPitchYSizeMeters"),
        *[F.col("matchId").alias("_matchId")] * ("matchId" in metadata.columns),
    )
    out.write.mode("overwrite").format("xml").option("rowTag", "match").option("rootTag", "matches").save(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = TABLE_FORMAT) -> DataFrame:
    """A stored table. Without a schema the files' own is used, with ``match_date`` as text.

    Spark infers a partition column's type from the folder names: ``0012`` would come back
    as 12, and two kick-off times of a day as that day. So the table is read again with the
    column declared as text, which takes the names as they are."""
    reader = spark.read.format(fmt)
    if schema is not None:
        return reader.schema(schema).load(path)
    df = reader.load(path)
    if dict(df.dtypes).get("match_date", "string") == "string":
        return df
    as_text = [T.StructField(f.name, T.StringType() if f.name == "match_date" else f.dataType) for f in df.schema.fields]
    return spark.read.format(fmt).schema(T.StructType(as_text)).load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the cluster's file system (Hadoop FS API).

    File-system errors (permissions, a store that does not answer) fail the call: a
    table that cannot be reached must not be taken for one that is absent. Sessions
    without a JVM gateway (Spark Connect) list the path through the binary-file source."""
    try:
        sc = spark.sparkContext
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - Spark Connect has no gateway
        jvm = None
    if jvm is not None:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return bool(hpath.getFileSystem(conf).exists(hpath))
    from pyspark.errors import AnalysisException

    try:
        spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
        return True
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
