"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where it names none, one of our own on a local master, as in tests; on a cluster
    that is an error, since executors would write where nobody else reads."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
    return held.get()


def _own(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession) -> str:
    """A path for a table of this application."""
    return f"{_own(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows, written once as Parquet and read from there by every later step, until `clear`."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has written here; results that still read them end with them."""
    delete(spark, _own(spark))
