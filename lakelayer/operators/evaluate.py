"""Classifier evaluation, business value and release gates (survey O3,
O5-O7, P1, P8, P9).  Counts are conditional sums in one aggregate; ranking
metrics work on the per-score count table (one row per distinct score),
never on a driver-side copy of the predictions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fill import RANGES, running_sum

# Cost matrix of the churn campaign (true negative, false
# positive, false negative, true positive), applied as given.
DEFAULT_COSTS = {"tn": 0.0, "fp": -1.0, "fn": 4.0, "tp": 3.0}


def confusion(df: DataFrame, label: str, pred: str, pos=1) -> DataFrame:
    lab, prd = F.col(label) == F.lit(pos), F.col(pred) == F.lit(pos)
    return df.agg(
        F.count_if(~lab & ~prd).alias("tn"),
        F.count_if(~lab & prd).alias("fp"),
        F.count_if(lab & ~prd).alias("fn"),
        F.count_if(lab & prd).alias("tp"),
    )


def _ratio(n: Column, d: Column) -> Column:
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def score_counts(df: DataFrame, label: str, score: str, pos=1) -> DataFrame:
    """(score, pos, neg): positives / negatives per distinct score."""
    is_pos = (F.col(label) == F.lit(pos)).cast("long")
    return df.groupBy(F.col(score).alias("score")).agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg"))


def roc_auc(df: DataFrame, label: str, score: str, pos=1) -> DataFrame:
    """ROC AUC with tied scores counted one half (= average ranks):
    ``sum_s pos(s) * (neg(<s) + neg(s)/2) / (P*N)``.  The cumulative negatives
    run over the per-score table in ranges of equal size."""
    sc = score_counts(df, label, score, pos)
    cum = running_sum(sc, ["neg"], [], ["score"], RANGES)
    part = cum.withColumn("_c", F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0))
    return part.agg(
        F.when((F.sum("pos") > 0) & (F.sum("neg") > 0), F.sum("_c") / (F.sum("pos") * F.sum("neg"))).alias("roc_auc")
    )


def binary_metrics(df: DataFrame, label: str, pred: str, score: str | None = None, pos=1, digits: int = 6) -> DataFrame:
    """O3: accuracy, precision, recall, F1 (positive class), confusion counts
    and ROC AUC, long form ``(metric, value)``."""
    c = confusion(df, label, pred, pos)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    prec, rec = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    m = c.select(
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        _ratio(2 * prec * rec, prec + rec).alias("f1"),
        tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
    )
    names = ["accuracy", "precision", "recall", "f1", "tp", "fp", "fn", "tn"]
    long = m.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])).alias("r"))
    out = long.select("r.metric", "r.value")
    if score:
        auc = roc_auc(df, label, score, pos).select(F.lit("roc_auc").alias("metric"), F.col("roc_auc").alias("value"))
        out = out.unionByName(auc)
    return out.withColumn("value", F.round("value", digits))


def roc_points(df: DataFrame, label: str, score: str, pos=1, digits: int = 6) -> DataFrame:
    """One ROC point per distinct score threshold (score >= t is
    positive): ``(threshold, tpr, fpr)``.  Totals come from one aggregate row."""
    sc = score_counts(df, label, score, pos)
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    P, N = float(tot["P"] or 0), float(tot["N"] or 0)
    cum = running_sum(sc, ["pos", "neg"], [], [F.col("score").desc()], RANGES)
    return cum.select(
        F.col("score").alias("threshold"),
        F.round(F.col("cum_pos") / F.lit(P if P else 1.0), digits).alias("tpr"),
        F.round(F.col("cum_neg") / F.lit(N if N else 1.0), digits).alias("fpr"),
    )


def classification_report(df: DataFrame, label: str, pred: str, digits: int = 6) -> DataFrame:
    """Per class precision, recall, F1 and support.  Each row counts for
    its true class and its predicted class (one exploded aggregate)."""
    hit = F.col(label) == F.col(pred)
    parts = F.when(
        hit, F.array(F.struct(F.col(label).alias("cls"), F.lit(1).alias("t"), F.lit(1).alias("p"), F.lit(1).alias("tp")))
    ).otherwise(
        F.array(
            F.struct(F.col(label).alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("tp")),
            F.struct(F.col(pred).alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("tp")),
        )
    )
    g = (
        df.select(F.explode(parts).alias("e"))
        .groupBy(F.col("e.cls").alias("class"))
        .agg(F.sum("e.t").alias("support"), F.sum("e.p").alias("predicted"), F.sum("e.tp").alias("tp"))
    )
    p = _ratio(F.col("tp").cast("double"), F.col("predicted"))
    r = _ratio(F.col("tp").cast("double"), F.col("support"))
    return g.select(
        "class",
        F.round(p, digits).alias("precision"),
        F.round(r, digits).alias("recall"),
        F.round(_ratio(2 * p * r, p + r), digits).alias("f1"),
        F.col("support").cast("long").alias("support"),
    )


def business_value(df: DataFrame, label: str, pred: str, costs: Mapping[str, float] = DEFAULT_COSTS, pos=1) -> DataFrame:
    """Confusion counts times the cost matrix, summed."""
    c = confusion(df, label, pred, pos)
    value = sum((F.col(k) * F.lit(float(costs[k])) for k in ("tn", "fp", "fn", "tp")), F.lit(0.0))
    return c.withColumn("value", value)


def compare_models(scores: DataFrame, metric: str = "f1", candidate: str = "challenger", champion: str = "champion",
                   model_col: str = "model") -> DataFrame:
    """The candidate passes when its score is >= the champion's; no
    champion means it passes.  One grouped aggregate, no driver logic."""
    a = scores.agg(
        F.max(F.when(F.col(model_col) == candidate, F.col(metric))).alias("candidate_score"),
        F.max(F.when(F.col(model_col) == champion, F.col(metric))).alias("champion_score"),
    )
    return a.withColumn(
        "passed",
        F.col("candidate_score").isNotNull()
        & (F.col("candidate_score") >= F.coalesce(F.col("champion_score"), F.lit(float("-inf")))),
    )


def approval(checks: DataFrame, ok: str = "ok") -> DataFrame:
    """AND of all check outcomes -> ``Approved`` / ``Failed``."""
    return checks.agg(F.bool_and(F.coalesce(F.col(ok), F.lit(False))).alias("all_ok"), F.count(F.lit(1)).alias("n_checks")).withColumn(
        "status", F.when(F.col("all_ok"), "Approved").otherwise("Failed")
    )


def leaderboard(results: DataFrame, metric: str = "f1", order_col: str = "trial") -> DataFrame:
    """Runs ranked by the metric, descending; the earlier run wins a tie
    (strictly greater replaces the best)."""
    return results.orderBy(F.desc_nulls_last(metric), F.asc(order_col))
