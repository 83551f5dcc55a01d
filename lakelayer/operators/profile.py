"""Distributed profiling (survey D7-D9, D11, N8-N10, F3).

Every statistic is an aggregate with a map-side partial step.  Quantiles
are exact without collecting a group's values anywhere: values are counted
per distinct value (a hot value collapses map-side), the counts are
accumulated in value order with a chunked running sum (a hot group is split
into value ranges), and the q-quantile is the smallest value whose
cumulative count reaches ``ceil(q * n)`` (the discrete definition).  The
mergeable ``percentile_approx`` sketch remains available (``exact=False``).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .fill import RANGES, join_null_safe, running_sum

QUANTILE_ACCURACY = 100000


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and share of the total.  The total is a window sum
    over the (tiny) per-class result, so the data is scanned once."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 4))


def pos_weight(df: DataFrame, label: str, pos=1) -> DataFrame:
    """Negatives / positives in one conditional aggregate (NULL if no
    positive)."""
    is_pos = F.col(label) == F.lit(pos)
    a = df.agg(F.count_if(is_pos).alias("n_pos"), F.count_if(~is_pos).alias("n_neg"))
    return a.withColumn(
        "pos_weight", F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos")).otherwise(F.lit(None))
    )


def pivot_metric(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long metrics -> one column per listed metric name (listing the
    values avoids the extra distinct job of an open pivot)."""
    return df.groupBy(*keys).pivot(name, list(names)).agg(F.max(value))


def custom_metric(df: DataFrame, template: str, groups: Sequence[str] = (), **cols: str) -> DataFrame:
    """Aggregate from a template such as
    ``avg(CASE WHEN {{prediction_col}} = {{target_col}} THEN 1 ELSE 0 END)``."""
    return df.groupBy(*groups).agg(F.expr(fill_template(template, **cols)).alias("custom_metric"))


def fill_template(template: str, **cols: str) -> str:
    """``{{name}}`` replaced by the quoted column given for the name."""
    for k, v in cols.items():
        template = template.replace("{{" + k + "}}", f"`{v}`")
    return template


def correlations(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair (long form), all pairs in
    one aggregate."""
    pairs = list(combinations(cols, 2))
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    arr = F.array(
        *[
            F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.round(F.col(f"c{i}"), digits).alias("corr"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return one.select(F.explode(arr).alias("r")).select("r.*")


def top_correlated(df: DataFrame, cols: Sequence[str], target: str, k: int = 4, digits: int = 6) -> DataFrame:
    """the ``k`` features with the largest absolute correlation with the
    target (the limit is the feature; ties broken by name)."""
    one = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.round(F.col(c), digits).alias("corr")) for c in cols])
    long = one.select(F.explode(arr).alias("r")).select("r.*").withColumn("abs_corr", F.abs("corr"))
    return long.orderBy(F.desc("abs_corr"), "feature").limit(k)


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, groups: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over ``[lo, hi]`` (``hi`` goes to the last bin),
    counts per bin.  Bounds are parameters (or one aggregate row computed by
    :func:`value_range`)."""
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins)).cast("int")
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(*groups, b.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_lo", F.round(F.lit(lo) + (F.col("bin") - 1) * F.lit(width), 6))
    )


def value_range(df: DataFrame, col: str) -> tuple[float, float]:
    """One aggregate row: (min, max) of a column."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return float(r["lo"]), float(r["hi"])


def exact_quantiles(df: DataFrame, col: str, groups: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """Exact discrete quantiles per group: ``(groups..., n, min, max, q0..)``
    where ``q_i`` is the smallest value with ``count(<= value) >= ceil(q*n)``.

    Work: one aggregate to (group, value, count), one to per-group stats,
    then a running count over the values in ranges of equal size, however they
    are spread; the final pick is a conditional ``min`` per group."""
    groups = list(groups)
    v = df.select(*groups, F.col(col).alias("_v")).filter(F.col("_v").isNotNull())
    counts = v.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c"))
    stats_aggs = [F.sum("_c").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    if groups:
        d = join_null_safe(counts, counts.groupBy(*groups).agg(*stats_aggs), groups)
    else:  # one row of bounded size: inline it rather than join on nothing
        st = counts.agg(*stats_aggs).first()
        d = counts.withColumns({"_n": F.lit(st["_n"]), "_lo": F.lit(st["_lo"]), "_hi": F.lit(st["_hi"])})
    cum = running_sum(d, ["_c"], groups, ["_v"], RANGES, prefix="_cum")
    picks = [
        F.min(F.when(F.col("_cum_c") >= F.greatest(F.ceil(F.lit(float(q)) * F.col("_n")), F.lit(1)), F.col("_v"))).alias(f"q{i}")
        for i, q in enumerate(qs)
    ]
    out = cum.groupBy(*groups).agg(
        F.first("_n").alias("n"), F.first("_lo").alias("min"), F.first("_hi").alias("max"), *picks
    )
    return out.withColumn("n", F.col("n").cast("long"))


def box_stats(df: DataFrame, col: str, groups: Sequence[str], accuracy: int = QUANTILE_ACCURACY,
              exact: bool = True) -> DataFrame:
    """Quartiles, IQR and 1.5xIQR whiskers per group."""
    if exact:
        s = exact_quantiles(df, col, groups, [0.25, 0.5, 0.75]).select(
            *groups, "n", "min", "max", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
        )
    else:
        q = F.percentile_approx(col, [0.25, 0.5, 0.75], accuracy)
        s = df.groupBy(*groups).agg(q.alias("_q"), F.count(col).alias("n"), F.min(col).alias("min"), F.max(col).alias("max"))
        s = s.select(
            *groups, "n", "min", "max",
            F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"),
        )
    iqr = F.col("q3") - F.col("q1")
    return s.withColumns({"lower_fence": F.col("q1") - 1.5 * iqr, "upper_fence": F.col("q3") + 1.5 * iqr})


def outliers(df: DataFrame, col: str, groups: Sequence[str], accuracy: int = QUANTILE_ACCURACY,
             exact: bool = True) -> DataFrame:
    """Rows outside the 1.5xIQR fences of their group.  The per-group
    fence table has one row per group; AQE broadcasts it when small."""
    fences = box_stats(df, col, groups, accuracy, exact).select(*groups, "lower_fence", "upper_fence")
    j = join_null_safe(df, fences, list(groups))
    return j.filter((F.col(col) < F.col("lower_fence")) | (F.col(col) > F.col("upper_fence"))).drop(
        "lower_fence", "upper_fence"
    )


def terciles(df: DataFrame, col: str, out: str = "tercile", accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    """Target terciles (quantile cut in three) from one sketch aggregate."""
    r = exact_quantiles(df, col, [], [1 / 3, 2 / 3]).first()
    cuts = [r["q0"], r["q1"]]
    t = F.when(F.col(col) <= F.lit(cuts[0]), 1).when(F.col(col) <= F.lit(cuts[1]), 2).otherwise(3)
    return df.withColumn(out, F.when(F.col(col).isNull(), F.lit(None)).otherwise(t))


def linear_fit(df: DataFrame, features: Sequence[str], target: str, digits: int = 6) -> DataFrame:
    """Least-squares line of the target on each feature (slope,
    intercept, r2), all features in one aggregate."""
    aggs = []
    for i, c in enumerate(features):
        aggs += [
            F.regr_slope(target, c).alias(f"s{i}"),
            F.regr_intercept(target, c).alias(f"i{i}"),
            F.regr_r2(target, c).alias(f"r{i}"),
        ]
    one = df.agg(*aggs)
    arr = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.round(F.col(f"s{i}"), digits).alias("slope"),
                F.round(F.col(f"i{i}"), digits).alias("intercept"),
                F.round(F.col(f"r{i}"), digits).alias("r2"),
            )
            for i, c in enumerate(features)
        ]
    )
    return one.select(F.explode(arr).alias("r")).select("r.*")
