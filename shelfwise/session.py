"""Session helpers: a local session for tests and a shared folder for checkpoints and sinks."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "shelfwise") -> SparkSession:
    """Session used by tests and the bench; on a cluster the caller brings its own session."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one (tests) gets a scratch folder; on a cluster that is an error, since every
    machine would write to its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="shelfwise-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable (shared-storage) checkpoint; never a local one."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_scratch: list[str] = []  # paths of the tables written so far


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for written tables, placed under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return noted(os.path.join(base.replace("file:", "", 1) if base.startswith("file:") else base,
                              "tables", f"{name}-{uuid.uuid4().hex[:12]}"))


def noted(path: str) -> str:
    """``path``, remembered for ``drop_scratch``."""
    _scratch.append(path)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete one table written under a path of ``scratch_path``, once nothing reads it any more."""
    _scratch.remove(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> int:
    """Delete every table written under a fresh path so far, and say how many there were.

    For the caller, once the results are consumed: results read these tables until then. Nothing else in the folder is touched.
    """
    jvm, done = spark._jvm, 0
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        done += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return done
