"""Session helpers shared by the jobs, the tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "fleetlens", **conf: str) -> SparkSession:
    """A local session with the settings the jobs are tested under."""
    folder = os.path.join(tempfile.gettempdir(), "fleetlens-checkpoints")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file://{folder}")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure checkpoint() has a folder and return it.

    A cluster names a shared folder in ``spark.checkpoint.dir``. A local master
    without that setting gets one below Spark's own local folder.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = os.path.join(tempfile.gettempdir(), "fleetlens-checkpoints")
    context.setCheckpointDir(folder)
    return folder
