"""Model monitoring: daily profile metrics per model version and slice,
distribution drift between windows, metric merge and violation rules
(survey I8, P2-P7).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .fill import join_null_safe

# Violation thresholds as used by the drift check.
PERF_MIN, LOSS_MAX, DRIFT_MAX = 0.5, 30.0, 0.19


def slices(df: DataFrame, cols: Sequence[str] = (), exprs: Sequence[str] = ()) -> DataFrame:
    """One copy of each row per slice: the whole table (NULL key and
    value), each value of each slicing column, and each boolean expression."""
    items = [F.struct(F.lit(None).cast("string").alias("slice_key"), F.lit(None).cast("string").alias("slice_value"))]
    items += [F.struct(F.lit(c).alias("slice_key"), F.col(c).cast("string").alias("slice_value")) for c in cols]
    items += [F.struct(F.lit(e).alias("slice_key"), F.expr(e).cast("string").alias("slice_value")) for e in exprs]
    return df.withColumn("_s", F.explode(F.array(*items))).select("*", "_s.*").drop("_s")


def _div0(n: Column, d: Column) -> Column:
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def profile_metrics(
    df: DataFrame,
    ts: str,
    label: str,
    pred: str,
    group: Sequence[str] = ("model_version",),
    slice_cols: Sequence[str] = (),
    slice_exprs: Sequence[str] = (),
    window: str = "1 day",
    custom: str | None = None,
    digits: int = 6,
) -> DataFrame:
    """Per tumbling window x group x slice: row count, accuracy,
    support-weighted precision and recall, macro F1 over the classes seen
    (true or predicted), and an optional custom aggregate (P4).  Each row
    counts for its true and its predicted class; per-class counts are one
    aggregate, the averages a second one over the small per-class table."""
    d = slices(df.withColumn("window", F.window(ts, window)), slice_cols, slice_exprs)
    keys = ["window", *group, "slice_key", "slice_value"]
    base = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
        *([F.expr(custom).alias("custom_metric")] if custom else []),
    )
    hit = F.col(label) == F.col(pred)
    parts = F.when(hit, F.array(F.struct(F.col(label).alias("cls"), F.lit(1).alias("t"), F.lit(1).alias("p"), F.lit(1).alias("tp")))).otherwise(
        F.array(
            F.struct(F.col(label).alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("tp")),
            F.struct(F.col(pred).alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("tp")),
        )
    )
    per_class = (
        d.select(*keys, F.explode(parts).alias("e"))
        .groupBy(*keys, F.col("e.cls").alias("cls"))
        .agg(F.sum("e.t").alias("sup"), F.sum("e.p").alias("prd"), F.sum("e.tp").alias("tp"))
    )
    p = _div0(F.col("tp").cast("double"), F.col("prd"))
    r = _div0(F.col("tp").cast("double"), F.col("sup"))
    per_class = per_class.withColumns({"prec": p, "rec": r}).withColumn(
        "f1", _div0(2 * F.col("prec") * F.col("rec"), F.col("prec") + F.col("rec"))
    )
    avg = per_class.groupBy(*keys).agg(
        _div0(F.sum(F.col("sup") * F.col("prec")), F.sum("sup")).alias("precision_weighted"),
        _div0(F.sum(F.col("sup") * F.col("rec")), F.sum("sup")).alias("recall_weighted"),
        F.avg("f1").alias("f1_macro"),
    )
    # slice_key / slice_value are NULL on the whole-table slice: null-safe join
    b, a = base.alias("b"), avg.alias("a")
    cond = [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]
    out = b.join(a, cond, "inner").select("b.*", *[F.col(f"a.{c}") for c in avg.columns if c not in keys])
    num = [c for c in ("accuracy", "precision_weighted", "recall_weighted", "f1_macro", "custom_metric") if c in out.columns]
    out = out.withColumns({c: F.round(c, digits) for c in num})
    return out.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *[c for c in out.columns if c != "window"],
    )


@F.pandas_udf(T.DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-squared distribution, ``Q(dof/2, stat/2)``: the
    regularised upper incomplete gamma by its series below ``a + 1`` and by
    Lentz's continued fraction above, each until it converges.  A row is one
    (window, group), so few rows come here."""
    from math import exp, isfinite, lgamma, log

    def tail(x: float, a: float) -> float:
        if not (isfinite(x) and isfinite(a)) or a <= 0:
            return float("nan")
        if x <= 0:
            return 1.0
        front = exp(-x + a * log(x) - lgamma(a))
        if x < a + 1:
            term = total = 1.0 / a
            k = a
            while abs(term) > total * 1e-16:
                k += 1
                term *= x / k
                total += term
            return 1.0 - total * front
        tiny = 1e-300
        b = x + 1 - a
        c, d = 1 / tiny, 1 / b
        h, delta, k = d, 0.0, 0
        while abs(delta - 1) > 1e-15:
            k += 1
            an = -k * (k - a)
            b += 2
            d = 1 / (an * d + b or tiny)
            c = b + an / c or tiny
            delta = d * c
            h *= delta
        return front * h

    return pd.Series([tail(s / 2.0, d / 2.0) for s, d in zip(stat.astype(float), dof.astype(float), strict=True)], dtype=float)


def category_counts(df: DataFrame, ts: str, col: str, group: Sequence[str] = (), window: str = "1 day") -> DataFrame:
    """Counts per (window start, group, category)."""
    return (
        df.withColumn("_w", F.window(ts, window).start)
        .groupBy(F.col("_w").alias("window_start"), *group, F.col(col).cast("string").alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _round_out(agg: DataFrame, col: str, mode: str, digits: int) -> DataFrame:
    agg = agg.withColumn("chi_squared_pvalue", chi2_sf(F.col("chi_squared_statistic"), F.col("dof").cast("double")))
    num = ["js_distance", "tv_distance", "l_infinity_distance", "chi_squared_statistic", "chi_squared_pvalue"]
    return agg.withColumns({c: F.round(c, digits) for c in num}).withColumn("column_name", F.lit(col)).withColumn(
        "drift_type", F.lit(mode.upper())
    )


def drift(
    df: DataFrame,
    ts: str,
    col: str,
    group: Sequence[str] = (),
    mode: str = "consecutive",
    baseline: DataFrame | None = None,
    window: str = "1 day",
    digits: int = 6,
) -> DataFrame:
    """P5: distribution drift of a categorical column between each window and
    the previous window (``consecutive``) or a baseline table (``baseline``):
    Jensen-Shannon distance (sqrt of the divergence, log base 2, 0*log 0 = 0),
    total variation, L-infinity, chi-squared statistic and p-value over the
    union of categories.  Works on the (window x category) count table only:
    every count is taken as its own window's and as the next one's reference,
    and one aggregate brings both together (NULL categories included)."""
    cur = category_counts(df, ts, col, group, window)
    keys = ["window_start", *group]
    if mode != "consecutive":
        return _drift_vs_baseline(cur, baseline if baseline is not None else df, col, list(group), digits)
    step = F.expr(f"INTERVAL {window}")
    own = cur.select(*keys, "category", "n", F.lit(0).cast("long").alias("m"))
    ref = cur.select((F.col("window_start") + step).alias("window_start"), *group, "category", F.lit(0).cast("long").alias("n"), F.col("n").alias("m"))
    j = own.unionByName(ref).groupBy(*keys, "category").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    tot = Window.partitionBy(*keys)
    j = j.withColumns({"_tn": F.sum("n").over(tot), "_tm": F.sum("m").over(tot)}).filter("_tn > 0 AND _tm > 0")
    j = j.withColumns({"p": F.col("n") / F.col("_tn"), "q": F.col("m") / F.col("_tm")})
    mid = (F.col("p") + F.col("q")) / 2

    def kl(a):
        return F.when(F.col(a) > 0, F.col(a) * F.log2(F.col(a) / mid)).otherwise(F.lit(0.0))

    tot_all = F.col("_tn") + F.col("_tm")
    e_cur = (F.col("n") + F.col("m")) * F.col("_tn") / tot_all
    e_ref = (F.col("n") + F.col("m")) * F.col("_tm") / tot_all
    chi = F.when(e_cur > 0, (F.col("n") - e_cur) ** 2 / e_cur).otherwise(0.0) + F.when(
        e_ref > 0, (F.col("m") - e_ref) ** 2 / e_ref
    ).otherwise(0.0)
    agg = j.groupBy(*keys).agg(
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.sum(kl("p")) + 0.5 * F.sum(kl("q")))).alias("js_distance"),
        (0.5 * F.sum(F.abs(F.col("p") - F.col("q")))).alias("tv_distance"),
        F.max(F.abs(F.col("p") - F.col("q"))).alias("l_infinity_distance"),
        F.sum(chi).alias("chi_squared_statistic"),
        (F.count(F.lit(1)) - 1).alias("dof"),
    )
    return _round_out(agg, col, mode, digits)


def _drift_vs_baseline(cur: DataFrame, baseline: DataFrame, col: str, group: list[str], digits: int) -> DataFrame:
    """Each window against a fixed baseline distribution, without pairing
    windows with baseline categories (no cross join): a window's categories
    are joined with the baseline's counts on (group, category), and the terms
    of baseline categories absent from the window follow from totals (their JS
    and TV terms are ``q/2`` each, their chi-squared terms ``(N/M) * m``); their
    largest ``q`` for L-infinity is the first baseline category, by descending
    share, that the window lacks (rank = 1 + length of the matched prefix of
    ranks), joined on (group, rank).  All joins are NULL-safe."""
    one = F.lit(1).alias("_all")
    keys = ["window_start", *group]
    own = ["_all", *group]
    b = baseline.groupBy(one, *group, F.col(col).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("m"))
    order = Window.partitionBy(*own).orderBy(F.desc("m"), "category")
    b = b.withColumn("_r", F.row_number().over(order))
    sizes = b.groupBy(*own).agg(F.sum("m").alias("_tm"), F.count(F.lit(1)).alias("_bsize"))
    d = join_null_safe(cur.withColumn("_all", F.lit(1)), b, [*own, "category"])
    d = join_null_safe(d, sizes, own).withColumn("m", F.coalesce("m", F.lit(0)))
    d = d.withColumns(
        {
            "_tn": F.sum("n").over(Window.partitionBy(*keys)),
            "_rn": F.when(F.col("_r").isNotNull(), F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_r").asc_nulls_last()))),
        }
    )
    d = d.withColumns({"p": F.col("n") / F.col("_tn"), "q": F.col("m") / F.col("_tm")})
    mid = (F.col("p") + F.col("q")) / 2
    kl_p = F.col("p") * F.log2(F.col("p") / mid)
    kl_q = F.when(F.col("q") > 0, F.col("q") * F.log2(F.col("q") / mid)).otherwise(0.0)
    tot_all = F.col("_tn") + F.col("_tm")
    e_cur = (F.col("n") + F.col("m")) * F.col("_tn") / tot_all
    e_ref = (F.col("n") + F.col("m")) * F.col("_tm") / tot_all
    chi = F.when(e_cur > 0, (F.col("n") - e_cur) ** 2 / e_cur).otherwise(0.0) + F.when(
        e_ref > 0, (F.col("m") - e_ref) ** 2 / e_ref
    ).otherwise(0.0)
    agg = d.groupBy(*keys, "_all", "_tn", "_tm", "_bsize").agg(
        F.sum(kl_p).alias("_klp"),
        F.sum(kl_q).alias("_klq"),
        F.sum("q").alias("_qm"),
        F.sum("m").alias("_mm"),
        F.sum(0.5 * F.abs(F.col("p") - F.col("q"))).alias("_tv"),
        F.max(F.abs(F.col("p") - F.col("q"))).alias("_linf"),
        F.sum(chi).alias("_chi"),
        F.count(F.lit(1)).alias("_w"),
        F.count_if(F.col("_r").isNotNull()).alias("_both"),
        F.count_if(F.col("_r") == F.col("_rn")).alias("_prefix"),
    )
    missing_q = 1.0 - F.col("_qm")
    agg = join_null_safe(agg.withColumn("_r", (F.col("_prefix") + 1).cast("int")), b.select(*own, "_r", "m"), [*own, "_r"])
    q_next = F.col("m") / F.col("_tm")
    out = agg.select(
        *keys,
        F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.col("_klp") + 0.5 * F.col("_klq") + 0.5 * missing_q)).alias("js_distance"),
        (F.col("_tv") + 0.5 * missing_q).alias("tv_distance"),
        F.greatest(F.col("_linf"), F.coalesce(q_next, F.lit(0.0))).alias("l_infinity_distance"),
        (F.col("_chi") + F.col("_tn") / F.col("_tm") * (F.col("_tm") - F.col("_mm"))).alias("chi_squared_statistic"),
        (F.col("_w") + F.col("_bsize") - F.col("_both") - 1).alias("dof"),
    )
    return _round_out(out, col, "baseline", digits)


def all_metrics(perf: DataFrame, drift_long: DataFrame, keys: Sequence[str], names: Sequence[str],
                metric: str = "js_distance") -> DataFrame:
    """Performance rows joined (inner) with the drift metric pivoted to one
    column per drifting column name (listed values, no distinct pass)."""
    piv = drift_long.groupBy(*keys).pivot("column_name", list(names)).agg(F.first(metric, ignorenulls=True))
    return perf.join(piv, list(keys), "inner")


def violations(metrics: DataFrame, perf: str, loss: str, label_drift: str, pred_drift: str,
               perf_min: float = PERF_MIN, loss_max: float = LOSS_MAX, drift_max: float = DRIFT_MAX) -> DataFrame:
    """Performance violations (``perf < 0.5 and |loss| > 30``) plus drift
    violations (label and prediction drift both ``> 0.19``), counted and
    added -- one row can count twice -- in one aggregate."""
    pv = (F.col(perf) < perf_min) & (F.abs(F.col(loss)) > loss_max)
    dv = (F.col(label_drift) > drift_max) & (F.col(pred_drift) > drift_max)
    a = metrics.agg(F.count_if(pv).alias("performance_violations"), F.count_if(dv).alias("drift_violations"))
    return a.withColumn("all_violations", F.col("performance_violations") + F.col("drift_violations"))
