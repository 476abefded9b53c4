"""Where written tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def located(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without lies on the session's default file system, as Spark takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from ``spark.checkpoint.dir``, with its scheme; a mount of several file
    systems (``viewfs``) is followed to the one behind it, as tasks open files without Hadoop.

    Where it is unset, as in tests, a local session gets a temporary folder; elsewhere it is an error.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    place = spark._jvm.org.apache.hadoop.fs.Path(at)
    disk = place.getFileSystem(spark._jsc.hadoopConfiguration())
    disk.mkdirs(place)
    return disk.resolvePath(place).toString()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends here and lost executors cost nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete a table of :func:`stage` that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
