"""Point-in-time (as-of) join and training-set assembly (survey C7).

``asof_join`` attaches to every left row the latest right row of the same key
whose time is ``<=`` the left time (equal times match; no earlier row gives
NULL features).  Spark has no public as-of join, so it is composed from
public operators:

1. Both sides are tagged with a time bucket of ``bucket_secs``.  Left and
   right rows are unioned and, per ``(key, bucket)``, a running
   ``last(struct, ignorenulls)`` finds the in-bucket match.  No window
   partition holds more than one bucket of one key, so a hot key is spread
   over many tasks.
2. For left rows with no in-bucket match, the latest right row of an earlier
   bucket is needed: right rows are reduced to one row per ``(key, bucket)``
   (``max_by``, partial aggregation on the map side), and a running ``last``
   over that small table -- one row per key and bucket -- carries it forward.
3. An equi-join on ``(key, bucket)`` brings the carried row to the left rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import epoch_seconds
from ..sources.writers import staged

DAY = 86400


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str | None = None,
    features: Sequence[str] | None = None,
    bucket_secs: int = DAY,
) -> DataFrame:
    keys = list(keys)
    right_ts = right_ts or left_ts
    feats = list(features) if features is not None else [c for c in right.columns if c not in keys and c != right_ts]
    fstruct = F.struct(*[F.col(c) for c in feats])
    lcols = left.columns

    def bucket(c):
        return F.floor(epoch_seconds(c) / F.lit(bucket_secs))

    # A NULL key equals no key, so such feature rows can't match.
    right = right.dropna(how="any", subset=keys)
    L = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(left_ts).alias("_t"),
        bucket(left_ts).alias("_b"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in lcols]).alias("_l"),
        F.lit(None).cast(fstruct_type(right, feats)).alias("_f"),
    )
    R = right.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(right_ts).alias("_t"),
        bucket(right_ts).alias("_b"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(struct_type(left, lcols)).alias("_l"),
        fstruct.alias("_f"),
    )
    kcols = [f"_k{i}" for i in range(len(keys))]
    # Ties on time: right rows first (equal times match), then by feature
    # values so duplicate right rows resolve the same way on every run.
    w = (
        Window.partitionBy(*kcols, "_b")
        .orderBy("_t", "_side", "_f")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inb = (
        L.unionByName(R)
        .withColumn("_m", F.last("_f", ignorenulls=True).over(w))
        .filter(F.col("_side") == 1)
        .select(*kcols, "_b", "_l", "_m")
    )

    # One row per (key, bucket) holding the bucket's latest right row; left
    # buckets join with a NULL ordering, which max_by skips.
    seeds = R.select(*kcols, "_b", F.struct("_t", "_f").alias("_o"), "_f").unionByName(
        L.select(*kcols, "_b", F.lit(None).cast(R.select(F.struct("_t", "_f")).schema[0].dataType).alias("_o"), "_f")
    )
    wc = Window.partitionBy(*kcols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        seeds.groupBy(*kcols, "_b")
        .agg(F.max_by("_f", "_o").alias("_lb"))
        .withColumn("_carry", F.last("_lb", ignorenulls=True).over(wc))
        .select(*kcols, "_b", "_carry")
    )
    joined = inb.join(carry, [*kcols, "_b"], "left")
    m = F.coalesce(F.col("_m"), F.col("_carry"))
    return joined.select(
        *[F.col("_l").getField(c).alias(c) for c in lcols],
        *[m.getField(c).alias(c) for c in feats],
    )


def struct_type(df: DataFrame, cols: Sequence[str]):
    from pyspark.sql import types as T

    fields = {f.name: f for f in df.schema.fields}
    return T.StructType([T.StructField(c, fields[c].dataType, True) for c in cols])


def fstruct_type(df: DataFrame, cols: Sequence[str]):
    return struct_type(df, cols)


def training_set(
    labels: DataFrame,
    lookups: Sequence[tuple[DataFrame, Sequence[str], str, Sequence[str] | None]],
    ts: str,
    exclude: Sequence[str] = (),
    bucket_secs: int = DAY,
) -> DataFrame:
    """Labels enriched by several point-in-time lookups, then the excluded
    (identity / time) columns dropped.  Each lookup is ``(features, keys,
    feature_ts, feature_names)``.  A join reads both its sides twice, so the
    features asked for and the labels enriched so far are written once each."""
    out = labels
    for feats, keys, fts, names in lookups:
        feats = feats if names is None else feats.select(*dict.fromkeys([*keys, fts, *names]))
        out = asof_join(staged(out), staged(feats), keys, ts, fts, names, bucket_secs)
    return out.drop(*exclude)
