"""Scratch tables in the folder that the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A path for a new folder or table below ``spark.checkpoint.dir``, else below the warehouse.

    The first is the folder that a cluster shares. The warehouse is shared too
    unless it is a folder of the driver's disk; then, off a local master, this
    is an error. What is written there is removed when the session's file system
    is closed, so what is read from it must be used within the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
        if not sees_all(root, spark.sparkContext.master):
            raise ValueError(f"executors do not share {root}; name a shared folder in spark.checkpoint.dir")
    folder = f"{root.rstrip('/')}/opslake-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return f"{fs.makeQualified(path).toString()}/data"


def sees_all(path: str, master: str) -> bool:
    """Whether driver and executors see the same files at ``path``: not so on disks of several machines."""
    return master.startswith("local") or not path.startswith(("file:", "/"))


def saved(df: DataFrame, path: str) -> DataFrame:
    """Write once and go on from the files: cuts the lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
