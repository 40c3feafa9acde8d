"""Session helpers: a local session for tests and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library relies on. Session time zone is UTC so
# that dates and month truncation never depend on the machine.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# Dynamic partition overwrite is passed on each partitioned write instead of
# being set for the whole session.


# Recommended settings for a large cluster (not applied automatically): many
# shuffle partitions that AQE coalesces to ~256 MB, skewed partitions split,
# rebalance of skewed write partitions, scan splits of 256 MB.
CLUSTER_SETTINGS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}


def apply_cluster_settings(spark: SparkSession) -> None:
    """Apply ``CLUSTER_SETTINGS`` (all runtime SQL settings) to a session."""
    for key, value in CLUSTER_SETTINGS.items():
        spark.conf.set(key, value)


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "tslake") -> SparkSession:
    """A local session for tests and the bench; clusters pass their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tslake-warehouse-"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the session carries it. Only on a local master a folder of
    our own stands in for an unset one; elsewhere an unset folder is an error,
    because executors would not share a temporary one.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a shared folder for this session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tslake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tslake/{name}-{uuid.uuid4().hex[:12]}"
