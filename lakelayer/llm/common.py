"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.session import ensure_checkpoint_dir
from lakelayer.sources.writers import _fs

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The six ASCII white-space characters: \x20 and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RE = "[\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; the path may be of any scheme that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Paths of the tables that this process has written, oldest first.
TABLES: list[str] = []


def materialize(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the cluster's shared folder (``spark.checkpoint.dir``) and
    read it back: cuts the lineage, and survives lost executors.  The table stays
    until ``drop_tables``: a DataFrame that reads it may be used at any time."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    TABLES.append(path)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession, since: int = 0, keep: Collection[str] = ()) -> None:
    """Removes the tables that ``materialize`` has written from the ``since``-th on, but
    for those in ``keep``: for a caller whose result no longer reads them."""
    for path in [p for p in TABLES[since:] if p not in keep]:
        fs, p = _fs(spark, path)
        fs.delete(p, True)
        TABLES.remove(path)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; NULL text: no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RE), "")


def key(c: Column) -> Column:
    """A non-NULL string per value of a group column, NULL kept apart, in the
    order of the values with NULL last."""
    return F.coalesce(F.concat(F.lit("="), c), F.lit("~"))
