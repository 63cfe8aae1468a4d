"""Cutting lineage so that a lost executor costs one stage, not the whole job."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where that is unset, a local session gets a temporary folder that is deleted when the program ends. On several machines
    such a folder would be wrong, so there an unset folder is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="voxloom-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there.

    The files go when nothing refers to the result any more, if the session is set up for that
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name beside the checkpoints, for tables that a query writes and reads again."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` where it comes in fewer partitions than there are cores, else as it is.

    Small tables are often one file with one row group, which Spark reads in one task; work that is heavy per row would then
    leave all other cores idle. Large tables already come in many partitions and are left alone, and so is what comes out of
    a shuffle, whose partitions aren't known before it has run.
    """
    if "AdaptiveSparkPlan" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores // 2 else df
