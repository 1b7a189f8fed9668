"""Session settings the library relies on, and the shared scratch folder.

Every public entry point calls :func:`configure` on the session it is given, so a
caller's own session (a notebook, a cluster job, the test driver) behaves the same
as one built by :func:`build_session`.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# SQL settings that can be changed on a running session.
RUNTIME_CONF = {
    # Epoch-millisecond clocks become dates and times in UTC, never in the host zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Overwrites replace only the match partitions present in the output.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "touchline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for scripts and tests. Cluster jobs pass their own session."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", **RUNTIME_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``), also
    registered as the context's checkpoint folder for ``DataFrame.checkpoint``.
    Only a local session may leave it unset: a private folder is made for it. On a
    cluster such a folder would be the driver's alone, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master!r})")
        base = tempfile.mkdtemp(prefix="touchline-")
        spark.conf.set("spark.checkpoint.dir", base)
    _ensure_checkpoint_dir(spark, base)
    return base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The base is ``spark.checkpoint.dir`` as the session names it. Only when it is
    unset (a bare local test session) is a private folder made and registered.
    Every call returns a new sub-folder, so nothing is ever cleared or reused.
    """
    base = checkpoint_base(spark)
    return f"{base.rstrip('/')}/touchline/{name}-{uuid.uuid4().hex[:12]}"


def _ensure_checkpoint_dir(spark: SparkSession, base: str) -> None:
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)


def cluster_conf(input_bytes: int, executor_cores_total: int) -> dict[str, str]:
    """Suggested settings for a large run, from the input size and total cores.

    Shuffle partitions are sized for ~256 MB each after map-side aggregation
    (AQE coalesces smaller ones and splits skewed ones); scan splits are 512 MB.
    Pass the result to :func:`build_session` ``extra`` or the job's submit conf.
    """
    target = 256 * 1024 * 1024
    partitions = max(executor_cores_total * 2, input_bytes // target)
    return {
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.files.maxPartitionBytes": str(2 * target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
