"""Trailing time-range window features (survey E3-E5, N3, N5).

A sliding frame ``partitionBy(key).orderBy(ts).rangeBetween(-R, 0)`` would be
re-aggregated for every row, and one key holding a third of the table would
be one task.  ``rolling_many`` computes the same numbers from running sums:

* rows are first summed per (key, second), so same-second peers count;
* a key's timeline is cut into buckets (a day by default).  The cumulative
  value at a second is the total of all earlier buckets -- a running sum over
  the small (key, bucket) table -- plus a running sum inside (key, bucket);
* the frame of a row at ``t`` is the cumulative value at ``t`` minus the one just
  before ``t - R``, which a probe row placed into that second's bucket reads.

A row is placed once per frame besides its own place, whatever the frame's
length, and no window partition holds more than one bucket of one key.

Aggregates are given as ``(kind, expr)``: ``("sum", col)`` or
``("count", col | None)`` (``None`` counts rows).  A sum whose frame holds
no non-NULL value is NULL, as in SQL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import epoch_seconds
from .fill import join_null_safe

DAY = 86400
UNB = Window.unboundedPreceding

Agg = tuple[str, "Column | str | None"]


def _col(x):
    return F.col(x) if isinstance(x, str) else x


def rolling_many(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    frames: Mapping[int, Mapping[str, Agg]],
    bucket_secs: int = DAY,
) -> DataFrame:
    """Trailing frames ``[ts - range_secs, ts]`` (whole seconds), given as
    ``{range_secs: {name: (kind, expr)}}``, on one key."""
    keys = list(keys)
    sums, outs = {}, {}
    for secs, aggs in sorted(frames.items()):
        for name, (kind, expr) in aggs.items():
            if kind == "count":
                sums[f"_n_{name}"] = F.sum((F.lit(1) if expr is None else _col(expr).isNotNull()).cast("long"))
                outs[name] = (secs, F.col(f"_n_{name}"))
            elif kind == "sum":
                sums[f"_n_{name}"] = F.sum(_col(expr).isNotNull().cast("long"))
                sums[f"_s_{name}"] = F.coalesce(F.sum(_col(expr)), F.lit(0))
                outs[name] = (secs, F.when(F.col(f"_n_{name}") > 0, F.col(f"_s_{name}")))
            else:
                raise ValueError(f"unsupported rolling aggregate {kind!r} (sum, count)")
    staged = df.withColumn("_t", epoch_seconds(ts))
    # One row per key and second; the seconds a frame ends before are probes.
    per = staged.groupBy(*keys, "_t").agg(*[v.alias(c) for c, v in sums.items()])
    zero = [(F.col(c) - F.col(c)).alias(c) for c in sums]
    rows = per.select(*keys, F.col("_t").alias("_owner"), "_t", F.lit(0).alias("_frame"), *sums)
    for secs in frames:
        rows = rows.unionByName(per.select(*keys, F.col("_t").alias("_owner"), (F.col("_t") - secs).alias("_t"), F.lit(int(secs)).alias("_frame"), *zero))
    rows = rows.withColumn("_b", F.floor(F.col("_t") / F.lit(bucket_secs)))
    part = [*keys, "_b"]
    # Probes first: what stands at a frame's first second is inside.
    inside = Window.partitionBy(*part).orderBy("_t", (F.col("_frame") == 0).cast("int")).rowsBetween(UNB, 0)
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(UNB, -1)
    totals = rows.groupBy(*part).agg(*[F.sum(c).alias(c) for c in sums])
    totals = totals.select(*part, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before{c}") for c in sums])
    rows = join_null_safe(rows.withColumns({c: F.sum(c).over(inside) for c in sums}), totals, part)
    rows = rows.withColumns({c: F.col(c) + F.col(f"_before{c}") for c in sums})
    picked = []
    for name, (secs, _) in outs.items():
        for c in (x for x in sums if x[3:] == name):
            own, gone = F.when(F.col("_frame") == 0, F.col(c)), F.when(F.col("_frame") == secs, F.col(c))
            picked.append((F.sum(own) - F.sum(gone)).alias(c))
    framed = rows.groupBy(*keys, "_owner").agg(*picked)
    framed = framed.select(*keys, F.col("_owner").alias("_t"), *[v.alias(name) for name, (_, v) in outs.items()])
    return join_null_safe(staged, framed, [*keys, "_t"]).drop("_t")


def rolling(df: DataFrame, keys: Sequence[str], ts: str, range_secs: int, aggs: Mapping[str, Agg], bucket_secs: int = DAY) -> DataFrame:
    """One trailing frame ``[ts - range_secs, ts]``."""
    return rolling_many(df, keys, ts, {int(range_secs): aggs}, bucket_secs)


def rolling_sliding(df: DataFrame, keys: Sequence[str], ts: str, range_secs: int, aggs: Mapping[str, Column]) -> DataFrame:
    """The plain sliding-frame form (any aggregate, e.g. min / max), one
    window partition per key: for small groups or non-invertible aggregates."""
    w = Window.partitionBy(*keys).orderBy(epoch_seconds(ts)).rangeBetween(-int(range_secs), 0)
    return df.withColumns({n: a.over(w) for n, a in aggs.items()})


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` when ``den > 0`` else NULL."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.when(d > 0, n / d).otherwise(F.lit(None))


def user_behavior(
    purchases: DataFrame, user: str = "user_id", ts: str = "ts", price: str = "price", purchased: str = "purchased"
) -> DataFrame:
    """Trailing 7-day mean looked-up price (sum / count of all rows, NULL
    prices counted in the denominator) and trailing 6x30-day purchase count."""
    p = purchases.withColumn("_tickets", F.col(purchased).cast("int"))
    out = rolling_many(
        p,
        [user],
        ts,
        {
            7 * DAY: {"_sum7": ("sum", price), "_cnt7": ("count", None)},
            6 * 30 * DAY: {"_p6m": ("sum", "_tickets")},
        },
    )
    return out.select(
        user,
        ts,
        safe_ratio(F.col("_sum7").cast("double"), "_cnt7").alias("mean_price_7d"),
        F.col("_p6m").cast("double").alias("last_6m_purchases"),
    )


def destination_features(p: DataFrame, dest: str = "destination_id", ts: str = "ts", clicked: str = "clicked") -> DataFrame:
    """Trailing 7-day clicks and impressions per destination."""
    out = rolling(
        p.withColumn("_clicked", F.col(clicked).cast("int")),
        [dest],
        ts,
        7 * DAY,
        {"sum_clicks_7d": ("sum", "_clicked"), "sum_impressions_7d": ("count", None)},
    )
    return out.select(dest, ts, "sum_clicks_7d", "sum_impressions_7d")


def user_features(behavior: DataFrame, demography: DataFrame, user: str = "user_id", ts: str = "ts",
                  first_login: str = "first_login_date") -> DataFrame:
    """Behaviour features joined (left) to demography, plus tenure days
    (event date - first login date)."""
    return behavior.join(demography, user, "left").withColumn(
        "tenure_days", F.datediff(F.to_date(ts), F.col(first_login)).cast("long")
    )
