"""Session helpers.

The library never creates a session behind the caller's back; these helpers are
for tests, the bench and scripts.  ``shared_dir`` resolves the cluster-wide
folder named by ``spark.checkpoint.dir`` (set by the cluster); only when it is
unset (local tests) does it fall back to a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "dimfold") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("DIMFOLD_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Python call-site capture only enriches error messages; it costs a JVM round trip per expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # the UI is off: keep the status store small in long-lived sessions
        .config("spark.sql.ui.retainedExecutions", "50")
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "200")
        # release shuffle files and broadcasts of finished queries promptly in long-lived sessions
        .config("spark.cleaner.periodicGC.interval", "1min")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a local one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="dimfold-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the shared checkpoint folder (for written tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "dimfold", *parts, uuid.uuid4().hex])
