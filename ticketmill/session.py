"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}


def builder(app: str = "ticketmill") -> SparkSession.Builder:
    """A session builder with the settings the operators expect.

    Shuffle partitions are left to the cluster: adaptive execution coalesces them.
    """
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results: UTC and strict (ANSI) casts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a fresh temporary folder; on a cluster
    a machine-local folder would lose data with its executor, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="run-ticketmill-")
    return _local_dirs[app]
