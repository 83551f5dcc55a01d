"""Shared-folder helpers; tables are written by :mod:`lakelayer.sources.versions`."""

from __future__ import annotations

import uuid
from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def staging_path(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; it must name a shared folder")
    return f"{base.rstrip('/')}/_staging/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = staging_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
