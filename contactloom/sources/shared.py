"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names.

    Where that is unset a local session takes one below the temporary folder; on a cluster it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    base = folder.rstrip("/") if folder else f"{tempfile.gettempdir()}/checkpoints"
    return f"{base}/{label}-{uuid.uuid4().hex}"


def keep(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once in the shared folder and read back: what services answered is never asked for again, and outlives lost executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its files make fewer tasks than there are cores, so a small table in one file is not one task's work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scattered(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in several tasks for each core by the hash of ``keys``, for slow work on each row or work that makes many of it: a split of a narrow table's file holds millions."""
    return df.repartition(8 * df.sparkSession.sparkContext.defaultParallelism, *keys)


def bytes_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
