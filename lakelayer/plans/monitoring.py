"""Monitoring queries (survey I8, P2-P7) over ``events`` read as an
inference log: the label is "the event is a purchase", the prediction is
"value above 25", the model version alternates by user."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.monitor import all_metrics, drift, profile_metrics, violations
from ..operators.profile import fill_template
from ..sources.tables import Tables
from .registry import register

LOSS = "avg(CASE WHEN {{prediction_col}} != {{label_col}} AND {{label_col}} = 1 THEN -value ELSE 0 END)"


def inference_log(t: Tables):
    e = t.events
    return e.select(
        "event_id",
        "ts",
        "user_id",
        "value",
        F.col("event_type").alias("kind"),
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        (F.col("value") > 25).cast("int").alias("prediction"),
        F.concat(F.lit("v"), (F.col("user_id") % 2 + 1).cast("string")).alias("model_version"),
    )


LOG_SQL = """
lg AS (SELECT event_id, ts, user_id, value, event_type AS kind, CAST(event_type = 'purchase' AS INTEGER) AS label,
              CAST(value > 25 AS INTEGER) AS prediction, 'v' || CAST(user_id % 2 + 1 AS VARCHAR) AS model_version,
              time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM events),
sl AS (SELECT *, NULL::VARCHAR AS slice_key, NULL::VARCHAR AS slice_value FROM lg
       UNION ALL SELECT *, 'kind', kind FROM lg
       UNION ALL SELECT *, 'user_id % 3 = 0', CAST(user_id % 3 = 0 AS VARCHAR) FROM lg),
base AS (SELECT window_start, model_version, slice_key, slice_value, count(*) AS n,
                round(avg(CAST(label = prediction AS DOUBLE)), 6) AS accuracy,
                round(avg(CASE WHEN prediction <> label AND label = 1 THEN -value ELSE 0 END), 6) AS custom_metric
         FROM sl GROUP BY ALL),
e AS (SELECT window_start, model_version, slice_key, slice_value, label AS cls, 1 AS t,
             CAST(label = prediction AS INTEGER) AS p, CAST(label = prediction AS INTEGER) AS tp FROM sl
      UNION ALL SELECT window_start, model_version, slice_key, slice_value, prediction, 0, 1, 0 FROM sl WHERE label <> prediction),
pc AS (SELECT window_start, model_version, slice_key, slice_value, cls, sum(t) AS sup, sum(p) AS prd, sum(tp) AS tp
       FROM e GROUP BY ALL),
pc2 AS (SELECT *, CASE WHEN prd > 0 THEN tp / prd ELSE 0 END AS prec, CASE WHEN sup > 0 THEN tp / sup ELSE 0 END AS rec FROM pc),
pc3 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END AS f1 FROM pc2),
av AS (SELECT window_start, model_version, slice_key, slice_value,
              round(CASE WHEN sum(sup) > 0 THEN sum(sup * prec) / sum(sup) ELSE 0 END, 6) AS precision_weighted,
              round(CASE WHEN sum(sup) > 0 THEN sum(sup * rec) / sum(sup) ELSE 0 END, 6) AS recall_weighted,
              round(avg(f1), 6) AS f1_macro FROM pc3 GROUP BY ALL),
prof AS (SELECT b.window_start, b.window_start + INTERVAL 1 DAY AS window_end, b.model_version, b.slice_key, b.slice_value,
                n, accuracy, custom_metric, precision_weighted, recall_weighted, f1_macro
         FROM base b JOIN av a ON b.window_start = a.window_start AND b.model_version = a.model_version
           AND b.slice_key IS NOT DISTINCT FROM a.slice_key AND b.slice_value IS NOT DISTINCT FROM a.slice_value)"""


def _profile(t: Tables):
    loss = fill_template(LOSS, prediction_col="prediction", label_col="label")
    return profile_metrics(
        inference_log(t), "ts", "label", "prediction", ["model_version"], slice_cols=["kind"], slice_exprs=["user_id % 3 = 0"], custom=loss
    )


@register("profile_metrics_daily", f"WITH {LOG_SQL.strip()} SELECT * FROM prof")
def q_profile_metrics(spark, sf_dir):
    """Daily metrics per model version and slice."""
    return _profile(Tables(spark, sf_dir))


def _drift_sql(counts_cur: str, counts_ref: str) -> str:
    return f"""
cur AS ({counts_cur}),
ref AS ({counts_ref}),
j AS (SELECT coalesce(cur.window_start, ref.window_start) AS window_start, coalesce(cur.category, ref.category) AS category,
             coalesce(cur.n, 0) AS n, coalesce(ref.m, 0) AS m
      FROM cur FULL OUTER JOIN ref ON cur.window_start = ref.window_start AND cur.category = ref.category),
j2 AS (SELECT *, sum(n) OVER (PARTITION BY window_start) AS NN, sum(m) OVER (PARTITION BY window_start) AS MM FROM j),
j3 AS (SELECT *, n / NN AS p, m / MM AS q, (n + m) * NN / (NN + MM) AS ec, (n + m) * MM / (NN + MM) AS er FROM j2),
a AS (SELECT window_start,
        sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
                       + 0.5 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END))) AS js,
        0.5 * sum(abs(p - q)) AS tv, max(abs(p - q)) AS linf,
        sum(CASE WHEN ec > 0 THEN (n - ec) ^ 2 / ec ELSE 0 END + CASE WHEN er > 0 THEN (m - er) ^ 2 / er ELSE 0 END) AS chi,
        count(*) - 1 AS dof
      FROM j3 GROUP BY window_start)
SELECT window_start, round(js, 6) AS js_distance, round(tv, 6) AS tv_distance, round(linf, 6) AS l_infinity_distance,
       round(chi, 6) AS chi_squared_statistic, dof,
       round(CASE WHEN dof = 4 THEN exp(-chi / 2) * (1 + chi / 2) END, 6) AS chi_squared_pvalue,
       'event_type' AS column_name"""


CUR_COUNTS = "SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type AS category, count(*) AS n FROM events GROUP BY ALL"


@register(
    "drift_consecutive",
    f"""
WITH c0 AS ({CUR_COUNTS}),
w AS (SELECT DISTINCT window_start FROM c0 WHERE window_start - INTERVAL 1 DAY IN (SELECT window_start FROM c0)),
{_drift_sql('SELECT c0.* FROM c0 JOIN w USING (window_start)',
            'SELECT c0.window_start + INTERVAL 1 DAY AS window_start, category, n AS m FROM c0 WHERE c0.window_start + INTERVAL 1 DAY IN (SELECT window_start FROM w)')},
       'CONSECUTIVE' AS drift_type FROM a
""",
)
def q_drift_consecutive(spark, sf_dir):
    """P5: event-type distribution drift, each day vs the previous day."""
    ev = Tables(spark, sf_dir).events
    return drift(ev, "ts", "event_type", mode="consecutive")


@register(
    "drift_baseline",
    f"""
WITH c0 AS ({CUR_COUNTS}),
b AS (SELECT event_type AS category, count(*) AS m FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY ALL),
{_drift_sql('SELECT * FROM c0', 'SELECT w.window_start, b.category, b.m FROM (SELECT DISTINCT window_start FROM c0) w, b')},
       'BASELINE' AS drift_type FROM a
""",
)
def q_drift_baseline(spark, sf_dir):
    """P5: event-type distribution drift, each day vs the first week."""
    ev = Tables(spark, sf_dir).events
    base = ev.filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp"))
    return drift(ev, "ts", "event_type", mode="baseline", baseline=base)


def _js_sql(col: str) -> str:
    """Consecutive-day JS distance of ``col`` per model version."""
    return f"""
SELECT window_start, model_version, sqrt(greatest(0, 0.5 * sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END)
         + 0.5 * sum(CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END))) AS js
FROM (SELECT *, n / sum(n) OVER (PARTITION BY window_start, model_version) AS p,
             m / sum(m) OVER (PARTITION BY window_start, model_version) AS q
      FROM (SELECT coalesce(a.window_start, b.window_start) AS window_start,
                   coalesce(a.model_version, b.model_version) AS model_version,
                   coalesce(a.n, 0) AS n, coalesce(b.m, 0) AS m
            FROM (SELECT c.* FROM c_{col} c JOIN w_{col} USING (window_start, model_version)) a
            FULL OUTER JOIN (SELECT c.window_start + INTERVAL 1 DAY AS window_start, c.model_version, c.category, c.n AS m
                             FROM c_{col} c JOIN w_{col} w ON c.window_start + INTERVAL 1 DAY = w.window_start
                                                        AND c.model_version = w.model_version) b
              ON a.window_start = b.window_start AND a.model_version = b.model_version AND a.category = b.category))
GROUP BY window_start, model_version"""


def _counts_sql(col: str) -> str:
    return f"""
c_{col} AS (SELECT window_start, model_version, CAST({col} AS VARCHAR) AS category, count(*) AS n FROM lg GROUP BY ALL),
w_{col} AS (SELECT DISTINCT window_start, model_version FROM c_{col} x
            WHERE EXISTS (SELECT 1 FROM c_{col} y WHERE y.window_start = x.window_start - INTERVAL 1 DAY
                                                   AND y.model_version = x.model_version)),
d_{col} AS ({_js_sql(col)})"""


@register(
    "metrics_violations",
    f"""
WITH {LOG_SQL.strip()},
{_counts_sql('label').strip()},
{_counts_sql('prediction').strip()},
perf AS (SELECT window_start, model_version, f1_macro AS performance_metric, custom_metric AS expected_loss
         FROM prof WHERE slice_key IS NULL),
m AS (SELECT perf.*, dl.js AS label, dp.js AS prediction
      FROM perf JOIN d_label dl USING (window_start, model_version) JOIN d_prediction dp USING (window_start, model_version))
SELECT count(*) FILTER (WHERE performance_metric < 0.5 AND abs(expected_loss) > 30) AS performance_violations,
       count(*) FILTER (WHERE round(label, 6) > 0.19 AND round(prediction, 6) > 0.19) AS drift_violations,
       count(*) FILTER (WHERE performance_metric < 0.5 AND abs(expected_loss) > 30)
         + count(*) FILTER (WHERE round(label, 6) > 0.19 AND round(prediction, 6) > 0.19) AS all_violations
FROM m
""",
)
def q_metrics_violations(spark, sf_dir):
    """Whole-table daily F1 and expected loss per model joined with the
    pivoted label / prediction drift, then the violation counts."""
    t = Tables(spark, sf_dir)
    log = inference_log(t)
    perf = _profile(t).filter(F.col("slice_key").isNull()).select(
        F.col("window_start").alias("time"), "model_version",
        F.col("f1_macro").alias("performance_metric"), F.col("custom_metric").alias("expected_loss"),
    )
    d = drift(log, "ts", "label", ["model_version"]).unionByName(drift(log, "ts", "prediction", ["model_version"]))
    d = d.withColumnRenamed("window_start", "time")
    merged = all_metrics(perf, d, ["time", "model_version"], ["label", "prediction"])
    return violations(merged, "performance_metric", "expected_loss", "label", "prediction")
