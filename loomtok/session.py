"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "loomtok",
              shuffle_partitions: int | None = None,
              driver_memory: str | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join handling and Arrow on.

    On a cluster master, memory, shuffle partitions and
    ``spark.checkpoint.dir`` come from the submit configuration; only what
    the caller names here is set over it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        settings["spark.driver.memory"] = driver_memory
    spark = builder.config(map={**settings, **(conf or {})}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local["):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.  Only a session
    whose executors are threads of this machine may do without: it gets a
    scratch folder.  Anywhere else a missing setting is an error, since the
    other machines couldn't see such a folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="loomtok-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
