"""Reading the input tables and named layer tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(root: str, name: str, layer: str | None = None) -> str:
    """``root/[layer/]name`` -- the path convention that stands in for
    ``catalog.schema.table``.  A single-file table may carry a ``.parquet`` suffix."""
    base = os.path.join(root, layer, name) if layer else os.path.join(root, name)
    if "://" in base:
        return base + ".parquet" if layer is None and name in TEST_TABLES else base
    if not os.path.exists(base) and os.path.exists(base + ".parquet"):
        return base + ".parquet"
    return base


def table(spark: SparkSession, root: str, name: str, layer: str | None = None) -> DataFrame:
    """Batch read of a Parquet table; column pruning and filters reach the scan."""
    return spark.read.parquet(table_path(root, name, layer))


def stream_table(spark: SparkSession, root: str, name: str, layer: str | None = None) -> DataFrame:
    """Stream newly added files of a Parquet table (schema taken from the table)."""
    path = table_path(root, name, layer)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


class Tables:
    """Lazy attribute access to the input tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark = spark
        self._root = root

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self._spark, self._root, name)
