"""Spark session defaults for the warehouse.

UTC session zone (all warehouse timestamps are UTC wall-clock values),
ANSI mode on, adaptive execution with skew-join splitting and partition
coalescing on.  Settings already present on a cluster session are left alone,
except the session zone, which the semantics depend on.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark") -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them ``None`` and let the submit configuration decide.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEM", "8g"))
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (e.g. the driver's)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, "true")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it (a shared file system).  Only a local
    master, where driver and executors are one process, gets a private folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path and spark.sparkContext.getCheckpointDir():
        return path
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
