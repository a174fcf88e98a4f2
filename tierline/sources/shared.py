"""The folder that all executors share, and durable copies in it."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a temporary one only in local mode, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder: nothing to release, and a lost executor takes nothing with it."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables, wherever Spark keeps it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
