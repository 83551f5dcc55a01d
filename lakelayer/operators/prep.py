"""Preprocessing fitted on one frame and applied to others (survey N6,
N7, N11-N16, H19).

``Preprocessor.fit`` runs one aggregate (means, population standard
deviations, modes) and one small distinct per categorical column; the fitted
state is a handful of numbers and category lists, applied afterwards as
plain column expressions (no UDF, inside whole-stage codegen).  It gives one
output column per level; ``VectorPreprocessor`` is for columns of many levels.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import epoch_seconds
from ..sources.writers import staged
from .fill import with_ordinal

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def classify_columns(schema: T.StructType, overrides: dict[str, str] | None = None) -> dict[str, list[str]]:
    """Numeric / categorical / datetime / boolean column lists by type,
    with per-column overrides."""
    out: dict[str, list[str]] = {"numeric": [], "categorical": [], "datetime": [], "boolean": []}
    for f in schema.fields:
        kind = (overrides or {}).get(f.name)
        if kind is None:
            if isinstance(f.dataType, T.BooleanType):
                kind = "boolean"
            elif isinstance(f.dataType, NUMERIC):
                kind = "numeric"
            elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
                kind = "datetime"
            else:
                kind = "categorical"
        out.setdefault(kind, []).append(f.name)
    return out


def time_parts(col: str) -> dict[str, Column]:
    """Hour, weekday (Monday=0) and weekend flag."""
    wd = F.weekday(F.col(col))
    return {f"{col}_hour": F.hour(col), f"{col}_weekday": wd, f"{col}_is_weekend": (wd >= 5).cast("int")}


@dataclass
class Preprocessor:
    """Impute (mean for numeric, most frequent for categorical),
    standardise with the population std (std 0 divides by 1), one-hot with an
    optional dropped first level (unknown levels give all zeros), and
    datetime -> epoch seconds -> mean impute -> hour / weekday / weekend."""

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    datetime: Sequence[str] = ()
    drop_first: bool = False
    scale: bool = True
    stats: dict = field(default_factory=dict)
    levels: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> Preprocessor:
        aggs = []
        for c in self.numeric:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        for c in self.datetime:
            e = epoch_seconds(c)
            aggs += [F.avg(e).alias(f"m_{c}"), F.stddev_pop(e).alias(f"s_{c}")]
        self.stats = df.agg(*aggs).first().asDict() if aggs else {}
        for c in self.categorical:
            counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
            # Output columns, one per level: the caller's schema holds them anyway.
            rows = counts.collect()
            self.levels[c] = sorted(r[c] for r in rows)
            self.stats[f"mode_{c}"] = min(rows, key=lambda r: (-r["_n"], r[c]))[c] if rows else None
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        cols: dict[str, Column] = {}
        for c in self.numeric:
            m, s = self.stats[f"m_{c}"], self.stats[f"s_{c}"]
            v = F.coalesce(F.col(c).cast("double"), F.lit(m))
            cols[c] = (v - F.lit(m)) / F.lit(s if s else 1.0) if self.scale else v
        for c in self.datetime:
            m, s = self.stats[f"m_{c}"], self.stats[f"s_{c}"]
            e = F.coalesce(epoch_seconds(c).cast("double"), F.lit(m))
            ts = F.timestamp_seconds(e.cast("long"))
            wd = F.weekday(ts)
            cols[f"{c}_hour"] = F.hour(ts)
            cols[f"{c}_weekday"] = wd
            cols[f"{c}_is_weekend"] = (wd >= 5).cast("int")
            cols[f"{c}_epoch"] = (e - F.lit(m)) / F.lit(s if s else 1.0) if self.scale else e
        for c in self.categorical:
            filled = F.coalesce(F.col(c), F.lit(self.stats[f"mode_{c}"]))
            levels = self.levels[c][1:] if self.drop_first else self.levels[c]
            for lv in levels:
                cols[f"{c}_{lv}"] = (filled == F.lit(lv)).cast("int")
        out = df.withColumns(cols)
        return out.drop(*self.datetime)


@dataclass
class VectorPreprocessor:
    """N11/N13/N15 as one feature vector, for columns of any number of levels.

    Numbers are imputed by their mean and scaled by the population deviation; a
    category is imputed by its most frequent level (the smallest of those) and
    one-hot encoded.  The levels of a column are a table, numbered by a prefix
    scan over their order and joined to the rows, so no list of levels reaches the
    driver and a row's vector holds one entry per column, whatever their number.
    Levels that the fit hasn't seen give all zeros, and so does the first level
    with ``drop_first``.  ``save`` and ``load`` keep a fitted preprocessor in a folder."""

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    drop_first: bool = False
    stats: dict = field(default_factory=dict)
    levels: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> VectorPreprocessor:
        aggs = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in self.numeric]
        self.stats = {c: r.asDict() for c, r in df.agg(*aggs).first().asDict().items()} if aggs else {}
        for c in self.categorical:
            counts = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("level")).agg(F.count(F.lit(1)).alias("n"))
            numbered = staged(with_ordinal(counts, [], ["level"], "at").withColumn("at", F.col("at") - 1))
            top = numbered.agg(F.count(F.lit(1)).alias("size"), F.min_by("at", F.struct(-F.col("n"), "level")).alias("mode")).first()
            self.levels[c] = numbered.select("level", "at")
            self.stats[c] = {"size": top["size"], "mode": top["mode"]}
        return self

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``df`` plus the feature vector and, per category, ``<column>_index``: the place
        of its level in the order, NULL for an unknown one."""
        scaled = []
        for c in self.numeric:
            mean, std = self.stats[c]["mean"], self.stats[c]["std"]
            value = F.coalesce(F.col(c).cast("double"), F.lit(mean), F.lit(0.0))
            df = df.withColumn(f"_{c}_scaled", (value - F.lit(mean or 0.0)) / F.lit(std or 1.0))
            scaled.append(f"_{c}_scaled")
        vectors = []
        for c in self.categorical:
            size, mode = self.stats[c]["size"], self.stats[c]["mode"]
            found = self.levels[c].select(F.col("level").alias(c), F.col("at").alias(f"{c}_index"))
            df = df.join(found, c, "left").withColumn(f"{c}_index", F.when(F.col(c).isNull(), F.lit(mode)).otherwise(F.col(f"{c}_index")))
            first = 1 if self.drop_first else 0
            slots = max(size - first, 1)
            at = F.col(f"{c}_index") - first
            df = df.withColumn(f"_{c}_slot", F.when(at >= 0, at).otherwise(slots).cast("double"))  # slot ``slots`` is dropped
            df = df.withColumn(f"_{c}_slot", F.coalesce(f"_{c}_slot", F.lit(float(slots))))
            # The encoder learns its size from the last slot alone.
            last = df.sparkSession.createDataFrame([(float(slots - 1),)], f"`_{c}_slot` double")
            encoder = OneHotEncoder(inputCols=[f"_{c}_slot"], outputCols=[f"_{c}_vector"], handleInvalid="keep", dropLast=True).fit(last)
            df = encoder.transform(df)
            vectors.append(f"_{c}_vector")
        df = VectorAssembler(inputCols=[*scaled, *vectors], outputCol=out).transform(df)
        return df.drop(*scaled, *vectors, *[f"_{c}_slot" for c in self.categorical])

    def size(self) -> int:
        """Length of the feature vector."""
        return len(self.numeric) + sum(max(self.stats[c]["size"] - (1 if self.drop_first else 0), 1) for c in self.categorical)

    def save(self, spark: SparkSession, path: str) -> None:
        for c in self.categorical:
            self.levels[c].write.parquet(f"{path}/levels/{c}")
        state = {"numeric": list(self.numeric), "categorical": list(self.categorical), "drop_first": self.drop_first, "stats": self.stats}
        spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.text(f"{path}/state")  # written last

    @staticmethod
    def load(spark: SparkSession, path: str) -> VectorPreprocessor:
        state = json.loads(spark.read.text(f"{path}/state").first()[0])
        return VectorPreprocessor(**state, levels={c: spark.read.parquet(f"{path}/levels/{c}") for c in state["categorical"]})
