"""Session helpers: a local session for tests/bench, and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "snapdeck") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SNAPDECK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # local profile: list partition folders with a few tasks, not one per folder
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(max(8, 2 * _cores(cores))))
        # checkpoint files of materialized sides are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", os.environ.get("SNAPDECK_CLEAN_CHECKPOINTS", "true"))
        # local disk only: skip the .crc side file written next to every file
        .config("spark.hadoop.fs.file.impl", "org.apache.hadoop.fs.RawLocalFileSystem")
        .config("spark.hadoop.fs.file.impl.disable.cache", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _cores(cores: int | str) -> int:
    return os.cpu_count() or 8 if str(cores) == "*" else int(cores)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; we never invent a machine-local one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="snapdeck-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint root for tables a job writes."""
    import uuid

    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables-{uuid.uuid4().hex[:12]}/{name}"
