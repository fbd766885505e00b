"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a session should start with; a cluster's own values win.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_local_folders: dict[str, str] = {}


def local_session(name: str, cores: int | str = "*", **settings: str) -> SparkSession:
    """A session for tests and measurements on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(
    spark: SparkSession, input_bytes: int, per_task: int = 128 * 1024 * 1024
) -> int:
    """Let shuffles start with enough partitions for ``input_bytes``.

    Adaptive execution merges partitions that turn out small, but it cannot cut
    a shuffle into more than it started with.  Returns the number set; it never
    goes below the session's own.
    """
    width = max(shuffle_width(spark), -(-input_bytes // per_task))
    spark.conf.set(INITIAL_PARTITIONS, str(width))
    return width


def shuffle_width(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    return int(spark.conf.get(INITIAL_PARTITIONS, None) or usual)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, for staged results.

    It is the one the cluster names in ``spark.checkpoint.dir``.  Only a session
    on one machine may go without: it gets a fresh temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="claimscale-")
    return "file://" + os.path.abspath(_local_folders[app])
