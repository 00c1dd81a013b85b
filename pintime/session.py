"""Session construction and shared scratch space.

Scratch output (versioned snapshots, CSV round trips, lineage cuts) always goes
under the directory the cluster names in ``spark.checkpoint.dir``. Only when that
setting is absent (local tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "pintime") -> SparkSession:
    """Session with the settings the library relies on.

    AQE re-plans joins and coalesces partitions at runtime; skew-join splitting
    is on for hot keys. Timestamps stay ``timestamp_ntz`` end to end, so the
    session zone only matters for display; it is pinned to UTC anyway.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:      # else the cluster's own setting holds
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b.config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_root(spark: SparkSession) -> str | None:
    root = spark.sparkContext.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    return root or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint root. Only a local master may go without the setting: it
    gets a temporary folder; a cluster's executors would not share one."""
    root = _configured_root(spark)
    if root:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    # `spark.checkpoint.dir` cannot be changed on a running session; set the
    # context's checkpoint directory, which later calls read back
    root = tempfile.mkdtemp(prefix="pintime-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused directory path under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root.rstrip("/"), "pintime-scratch",
                        f"{label}-{uuid.uuid4().hex[:12]}")
