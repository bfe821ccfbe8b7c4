"""Shared storage for intermediate results."""

from __future__ import annotations

import atexit
import gc
import time
from uuid import uuid4

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, or the one the session was given for checkpoints."""
    folder = spark.conf.get(SHARED_FOLDER, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {SHARED_FOLDER} to a folder that all executors share")
    return folder


def use_checkpoint_dir(spark: SparkSession) -> None:
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, removed when the driver ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid4().hex}"
    atexit.register(remove, spark, folder)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder in any file system that Spark knows, if the session still runs."""
    context = spark.sparkContext
    if context._jsc is not None and context._jvm is not None:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of finished jobs now rather than when the driver next collects its garbage.

    What the first round sets free still refers to the shuffles of the last job; the second round gets those.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)
