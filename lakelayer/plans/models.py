"""Model queries (survey O1, O2, O4, O5, A12, J3): predictions have no SQL
equivalent; the rows of the inference log do."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.evaluate import leaderboard
from ..operators.models import FAMILIES, log_scores, refit_best, save, score, search, train, with_class_weight
from ..operators.sample import hash_split
from ..sources import versions
from ..sources.writers import staged, staging_path
from .churn import gold_churn
from .registry import register

FEATURES = ["event_count", "session_count", "total_amount", "total_item", "days_last_event", "days_last_transaction"]
INFERENCE_TS = "2024-01-31 12:00:00"


def _labelled(spark, sf_dir):
    g = gold_churn(spark, sf_dir)
    g = g.withColumn("churn", (F.col("order_count") <= 9).cast("int"))
    d = staged(hash_split(g, "user_id", 0.8, seed=11))  # planned once, read by every trial
    return with_class_weight(d, "churn", fit_on=d.filter("split = 'train'"))


@register("train_leaderboard")
def q_train_leaderboard(spark, sf_dir):
    """Seeded search over all families, ranked by validation F1."""
    d = _labelled(spark, sf_dir)
    tr, va = d.filter("split = 'train'"), d.filter("split = 'test'")
    trials = search(tr, va, FEATURES, "churn", families=tuple(FAMILIES), n_trials=2, weight="weight")
    return leaderboard(trials, "f1", "trial")


@register("batch_score")
def q_batch_score(spark, sf_dir):
    """Best model refit on all labelled rows, then every user scored and
    tagged with model version and inference time."""
    d = _labelled(spark, sf_dir)
    tr, va = d.filter("split = 'train'"), d.filter("split = 'test'")
    trials = search(tr, va, FEATURES, "churn", families=("logistic_regression",), n_trials=2, weight="weight")
    fam, _, model = refit_best(trials, tr, va, FEATURES, "churn", weight="weight")
    return score(model, d.drop("weight", "split"), f"{fam}-1", INFERENCE_TS).select(
        "user_id", "churn", "prediction", "model_version", "inference_timestamp"
    )


@register(
    "inference_log",
    f"""
SELECT u.user_id, 'logistic_regression-1' AS model_version, TIMESTAMP '{INFERENCE_TS}' AS inference_timestamp,
       CASE WHEN u.user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS batch, 2 AS last_version, TRUE AS scored
FROM (SELECT c_custkey AS user_id FROM customer WHERE c_custkey % 101 <> 0) u
WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = u.user_id) AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = u.user_id)
""",
)
def q_inference_log(spark, sf_dir):
    """A model is saved and loaded again for each of three runs of batch
    scoring; the run that repeats a batch leaves the log as it is."""
    d = _labelled(spark, sf_dir)
    model = train(d.filter("split = 'train'"), "logistic_regression", {"maxIter": 20}, FEATURES, "churn", weight="weight")
    path, log = staging_path(spark, "model"), staging_path(spark, "inference-log")
    save(model, path)
    rows = d.drop("weight", "split")
    for batch, rest in (("even", 0), ("odd", 1), ("even", 0)):
        log_scores(path, rows.filter(F.col("user_id") % 2 == rest), log, "logistic_regression-1", batch, INFERENCE_TS, ["user_id", "churn"])
    last = versions.version(spark, log).number + 1
    return versions.read(spark, log).select(
        "user_id", "model_version", "inference_timestamp", "batch", F.lit(last).alias("last_version"), F.col("prediction").isin(0, 1).alias("scored")
    )
