"""Session construction and shared-folder helpers.

On a cluster the session is built by the platform; ``configure`` only sets
what is unset. ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session and sets a local one only when none is configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cohortwise",
          extra: dict | None = None) -> SparkSession:
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("COHORTWISE_DRIVER_MEMORY", "8g"))
    )
    for k, v in {**DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply defaults that are not already set on an existing session."""
    for k, v in DEFAULTS.items():
        try:
            if spark.conf.get(k, None) in (None, ""):
                spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; a scratch folder
    is created only when the session has none (local tests)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    if not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for the cluster")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortwise-ckpt-"))
    return spark.sparkContext.getCheckpointDir()
