"""Staged tables: intermediate results written once and read many times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster; a local session without one gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="delayworks-")
    spark.sparkContext.setCheckpointDir(root)
    return root


_FORGOTTEN: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; what is there goes when the application ends."""
    folder = f"{staging_root(spark)}/{spark.sparkContext.applicationId}"
    if folder not in _FORGOTTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _FORGOTTEN.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage without keeping anything on the executors that computed it.
    Readers prune columns and push filters into the Parquet files, and the planner
    knows the real size of the table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
