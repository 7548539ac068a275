"""Folders that all executors share, for what a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, a temporary one, on one machine only. It goes when the driver ends."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="vistaloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    path = f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    return path


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """df as a written table: worked out once, whatever reads it, and no filter above it works its columns out again."""
    path = f"{folder(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
