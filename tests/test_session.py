"""Session rules: shared folder from spark.checkpoint.dir, pinned settings, sizing."""

from __future__ import annotations

from touchline.session import cluster_conf, configure, shared_dir


def test_shared_dir_lives_under_the_session_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a.startswith(base.rstrip("/") + "/touchline/x-") and a != b
    assert spark.sparkContext.getCheckpointDir() is not None


def test_configure_pins_utc_and_adaptive_execution(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"


def test_cluster_conf_sizes_partitions_from_data_and_cores():
    big = cluster_conf(100 * 1024**4, 8000)
    small = cluster_conf(10 * 1024**2, 64)
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600
    assert int(small["spark.sql.shuffle.partitions"]) == 128
