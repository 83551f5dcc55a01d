"""Evaluation queries (survey O3, O5-O7, P1, P8, P9) on ``documents`` x
``labels`` with a rule-based score (document length), no model needed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.evaluate import (
    approval,
    binary_metrics,
    business_value,
    classification_report,
    compare_models,
    roc_points,
)
from ..operators.quality import check_key
from ..sources.tables import Tables
from .registry import register


def scored(t: Tables, cut: float = 0.2):
    d = t.documents.join(t.labels, "doc_id", "inner")
    s = F.round(F.least(F.col("n_chars") / F.lit(5000.0), F.lit(1.0)), 3)
    return d.select(
        "doc_id", F.col("quality").alias("label"), s.alias("score"), (s >= F.lit(cut)).cast("int").alias("prediction")
    )


SCORED_SQL = """
sc AS (SELECT d.doc_id, l.quality AS label, round(least(d.n_chars / 5000.0, 1.0), 3) AS score
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
s AS (SELECT *, CAST(score >= 0.2 AS INTEGER) AS prediction FROM sc)"""


@register(
    "binary_metrics",
    f"""
WITH {SCORED_SQL.strip()},
c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
             count(*) FILTER (WHERE label <> 1 AND prediction = 1)::DOUBLE AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction <> 1)::DOUBLE AS fn,
             count(*) FILTER (WHERE label <> 1 AND prediction <> 1)::DOUBLE AS tn FROM s),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS prec,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS rec FROM c),
k AS (SELECT score, sum(CAST(label = 1 AS INTEGER)) AS pos, sum(CAST(label <> 1 AS INTEGER)) AS neg FROM s GROUP BY score),
kk AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM k),
auc AS (SELECT sum(pos * (cum_neg - neg + neg / 2.0)) / (sum(pos) * sum(neg)) AS v FROM kk)
SELECT 'accuracy' AS metric, round((tp + tn) / (tp + tn + fp + fn), 6) AS value FROM m
UNION ALL SELECT 'precision', round(prec, 6) FROM m
UNION ALL SELECT 'recall', round(rec, 6) FROM m
UNION ALL SELECT 'f1', round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END, 6) FROM m
UNION ALL SELECT 'tp', tp FROM m UNION ALL SELECT 'fp', fp FROM m UNION ALL SELECT 'fn', fn FROM m
UNION ALL SELECT 'tn', tn FROM m
UNION ALL SELECT 'roc_auc', round(v, 6) FROM auc
""",
)
def q_binary_metrics(spark, sf_dir):
    """O3: accuracy / precision / recall / F1 / confusion / ROC AUC."""
    return binary_metrics(scored(Tables(spark, sf_dir)), "label", "prediction", "score")


@register(
    "roc_points",
    f"""
WITH {SCORED_SQL.strip()},
k AS (SELECT score, sum(CAST(label = 1 AS INTEGER)) AS pos, sum(CAST(label <> 1 AS INTEGER)) AS neg FROM s GROUP BY score),
t AS (SELECT sum(pos) AS P, sum(neg) AS N FROM k)
SELECT score AS threshold,
       round(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / P, 6) AS tpr,
       round(sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / N, 6) AS fpr
FROM k, t
""",
)
def q_roc_points(spark, sf_dir):
    """ROC curve points, one per distinct score."""
    return roc_points(scored(Tables(spark, sf_dir)), "label", "score")


@register(
    "classification_report",
    f"""
WITH {SCORED_SQL.strip()},
e AS (SELECT label AS cls, 1 AS t, CAST(label = prediction AS INTEGER) AS p, CAST(label = prediction AS INTEGER) AS tp FROM s
      UNION ALL SELECT prediction, 0, 1, 0 FROM s WHERE label <> prediction),
g AS (SELECT cls, sum(t) AS support, sum(p) AS predicted, sum(tp) AS tp FROM e GROUP BY cls),
r AS (SELECT cls, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r, support FROM g)
SELECT cls AS class, round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, CAST(support AS BIGINT) AS support
FROM r
""",
)
def q_classification_report(spark, sf_dir):
    """Per-class precision / recall / F1 / support."""
    return classification_report(scored(Tables(spark, sf_dir)), "label", "prediction")


@register(
    "business_value",
    f"""
WITH {SCORED_SQL.strip()},
c AS (SELECT count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn,
             count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
             count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp FROM s)
SELECT tn, fp, fn, tp, CAST(tn * 0.0 + fp * -1.0 + fn * 4.0 + tp * 3.0 AS DOUBLE) AS value FROM c
""",
)
def q_business_value(spark, sf_dir):
    """Model value from the confusion counts and the cost matrix."""
    return business_value(scored(Tables(spark, sf_dir)), "label", "prediction")


def _f1_sql(cut: float, name: str) -> str:
    return f"""
SELECT '{name}' AS model, CASE WHEN tp + fp > 0 AND tp + fn > 0 AND tp > 0
   THEN round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))), 6) ELSE 0 END AS f1
FROM (SELECT count(*) FILTER (WHERE label = 1 AND score >= {cut})::DOUBLE AS tp,
             count(*) FILTER (WHERE label <> 1 AND score >= {cut})::DOUBLE AS fp,
             count(*) FILTER (WHERE label = 1 AND score < {cut})::DOUBLE AS fn FROM sc)"""


COMPARE_SQL = f"""
WITH {SCORED_SQL.strip()},
f AS ({_f1_sql(0.2, 'challenger')} UNION ALL {_f1_sql(0.5, 'champion')})
SELECT max(CASE WHEN model = 'challenger' THEN f1 END) AS candidate_score,
       max(CASE WHEN model = 'champion' THEN f1 END) AS champion_score,
       max(CASE WHEN model = 'challenger' THEN f1 END) >= coalesce(max(CASE WHEN model = 'champion' THEN f1 END), '-inf'::DOUBLE)
         AS passed
FROM f"""


def _model_scores(t: Tables):
    def f1_of(cut, name):
        m = binary_metrics(scored(t, cut), "label", "prediction")
        return m.filter(F.col("metric") == "f1").select(F.lit(name).alias("model"), F.col("value").alias("f1"))

    return f1_of(0.2, "challenger").unionByName(f1_of(0.5, "champion"))


@register("compare_models", COMPARE_SQL)
def q_compare_models(spark, sf_dir):
    """Challenger passes when its F1 is at least the champion's."""
    return compare_models(_model_scores(Tables(spark, sf_dir)))


@register(
    "approval",
    f"""
{COMPARE_SQL.replace('WITH ', 'WITH cmp AS (WITH ', 1)}),
k AS (SELECT count(*) = count(DISTINCT doc_id) AND count(*) FILTER (WHERE doc_id IS NULL) = 0 AS ok FROM labels),
checks AS (SELECT passed AS ok FROM cmp UNION ALL SELECT ok FROM k)
SELECT bool_and(coalesce(ok, FALSE)) AS all_ok, count(*) AS n_checks,
       CASE WHEN bool_and(coalesce(ok, FALSE)) THEN 'Approved' ELSE 'Failed' END AS status
FROM checks
""",
)
def q_approval(spark, sf_dir):
    """approval = AND of the model comparison and the label-key check."""
    t = Tables(spark, sf_dir)
    cmp = compare_models(_model_scores(t)).select(F.col("passed").alias("ok"))
    key = check_key(t.labels, ["doc_id"]).select("ok")
    return approval(cmp.unionByName(key))
