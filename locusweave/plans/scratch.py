"""A folder for files that a query writes and reads again, and tables kept there."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, the shared folder; a local one only where Spark itself is local and has none."""
    told = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not told:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        told = "file://" + tempfile.mkdtemp(prefix="spark-")
    path = f"{told}/locusweave/{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def saved(df: DataFrame, name: str) -> DataFrame:
    """df, written as a table in the shared folder and read again: computed once, and a lost executor costs only reads of it."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
