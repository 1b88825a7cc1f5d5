"""Session helpers: defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "lakeloom", memory: str = "16g",
                  checkpoints: str = "/tmp/checkpoints") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own session and shared folder."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(checkpoints)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or the one the caller has set with ``setCheckpointDir``.

    All executors must reach it, so that what is written there survives the loss of one. A session
    without either setting is refused rather than given a folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return base


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """Name of a new sub-folder of the cluster's checkpoint folder."""
    return os.path.join(checkpoint_root(spark), f"{purpose}-{uuid.uuid4().hex}")


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder made under ``shared_dir``; works on any file system Spark can write to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df):
    """Reliable checkpoint in the shared folder; survives the loss of an executor."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession, "lineage"))
    return df.checkpoint()
