"""Model training, search, scoring and leaderboard on ``pyspark.ml``
(survey O1, O2, O4, O5, J3).

Each trial is a distributed fit on the executors; the search loop only
holds trial parameters and one metric per trial.  The available families
are Spark's logistic regression, random forest and gradient-boosted trees
(class imbalance through ``weightCol``).
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.versions import Version, append
from .evaluate import binary_metrics

FAMILIES = {
    "logistic_regression": LogisticRegression,
    "random_forest": RandomForestClassifier,
    "gbt": GBTClassifier,
}

# Search spaces: lists to sample from (seeded), per family.
DEFAULT_SPACE = {
    "logistic_regression": {"regParam": [0.0, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [50]},
    "random_forest": {"numTrees": [20, 50, 100], "maxDepth": [3, 5, 8], "seed": [7]},
    "gbt": {"maxIter": [10, 20], "maxDepth": [2, 3, 5], "stepSize": [0.05, 0.1], "seed": [7]},
}


def with_class_weight(df: DataFrame, label: str, pos=1, col: str = "weight", fit_on: DataFrame | None = None) -> DataFrame:
    """Positive rows weighted by negatives / positives (D8) of ``fit_on`` (the
    training split; default: ``df``), one aggregate."""
    r = (df if fit_on is None else fit_on).agg(F.count_if(F.col(label) == pos).alias("p"), F.count_if(F.col(label) != pos).alias("n")).first()
    w = (r["n"] / r["p"]) if r["p"] and r["n"] else 1.0
    return df.withColumn(col, F.when(F.col(label) == pos, F.lit(float(w))).otherwise(F.lit(1.0)))


def train(df: DataFrame, family: str, params: Mapping, features: Sequence[str], label: str,
          weight: str | None = None) -> PipelineModel:
    """O1: assemble features and fit one classifier family."""
    est = FAMILIES[family](featuresCol="features", labelCol=label, **dict(params))
    if weight:
        est = est.setWeightCol(weight)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"), est])
    return pipe.fit(df)


def score(model: PipelineModel, df: DataFrame, version: str, ts: str, label_type: str = "int") -> DataFrame:
    """The model as a column function; prediction cast to the label
    type, model version and inference time added."""
    out = model.transform(df)
    return out.drop("features", "rawPrediction", "probability").withColumns(
        {
            "prediction": F.col("prediction").cast(label_type),
            "model_version": F.lit(version),
            "inference_timestamp": F.lit(ts).cast("timestamp"),
        }
    )


def save(model: PipelineModel, path: str) -> None:
    """A fitted model written to a shared folder; an existing one stays as it is."""
    model.write().save(path)


def log_scores(path: str, df: DataFrame, root: str, version: str, batch: str, ts: str, columns: Sequence[str], label_type: str = "int") -> Version:
    """The saved model is loaded, scores a batch, and ``columns`` of the
    scored rows are appended to the inference log, a table of committed versions.
    A batch of a model version enters the log once, however often it is repeated."""
    scored = score(PipelineModel.load(path), df, version, ts, label_type).withColumn("batch", F.lit(batch))
    return append(scored, root, [*columns, "prediction", "model_version", "inference_timestamp", "batch"], batch=f"{version}/{batch}")


def _f1(model: PipelineModel, df: DataFrame, label: str) -> float | None:
    m = binary_metrics(model.transform(df).withColumn("prediction", F.col("prediction").cast("int")), label, "prediction")
    r = m.filter(F.col("metric") == "f1").first()
    return None if r is None else float(r["value"])


def search(train_df: DataFrame, val_df: DataFrame, features: Sequence[str], label: str,
           families: Sequence[str] = ("logistic_regression", "random_forest"), n_trials: int = 3, seed: int = 42,
           space: Mapping[str, Mapping[str, list]] | None = None, weight: str | None = None,
           parallelism: int = 2) -> DataFrame:
    """O2: seeded random search maximising F1 on the validation split; a
    failed trial scores NULL (its error is kept) and is ranked last.
    Returns the trial table ``(trial, family, params, f1, error)``; the best
    is refit on train+validation by :func:`refit_best`.

    Trial parameters are drawn up front (the seed alone decides them), and
    up to ``parallelism`` trials are fitted at once -- each fit is a series
    of distributed jobs, so concurrent trials keep the executors busy, as
    ``pyspark.ml``'s own tuning does with its ``parallelism``."""
    from concurrent.futures import ThreadPoolExecutor

    space = space or DEFAULT_SPACE
    rng = random.Random(seed)
    plan = []
    for fam in families:
        for _ in range(n_trials):
            plan.append((len(plan), fam, {k: rng.choice(v) for k, v in space[fam].items()}))
    # every trial scans the same inputs: keep them on the executors (memory,
    # spilling to disk) instead of recomputing the feature plan per trial;
    # a lost executor recomputes its blocks from the lineage
    train_df = train_df.persist(StorageLevel.MEMORY_AND_DISK)
    val_df = val_df.persist(StorageLevel.MEMORY_AND_DISK)

    def run(item):
        trial, fam, params = item
        try:
            f1 = _f1(train(train_df, fam, params, features, label, weight), val_df, label)
            return trial, fam, repr(sorted(params.items())), f1, None
        except Exception as exc:  # noqa: BLE001 - failed trial = NULL score
            return trial, fam, repr(sorted(params.items())), None, f"{type(exc).__name__}: {str(exc)[:300]}"

    try:
        with ThreadPoolExecutor(max_workers=max(1, int(parallelism))) as pool:
            rows = list(pool.map(run, plan))
    finally:
        train_df.unpersist()
        val_df.unpersist()
    schema = T.StructType(
        [
            T.StructField("trial", T.IntegerType()),
            T.StructField("family", T.StringType()),
            T.StructField("params", T.StringType()),
            T.StructField("f1", T.DoubleType()),
            T.StructField("error", T.StringType()),
        ]
    )
    return train_df.sparkSession.createDataFrame(rows, schema)


def refit_best(trials: DataFrame, train_df: DataFrame, val_df: DataFrame, features: Sequence[str], label: str,
               weight: str | None = None) -> tuple[str, dict, PipelineModel]:
    """The best trial (highest F1, earliest on ties) refit on
    train + validation."""
    from ast import literal_eval

    best = trials.orderBy(F.desc_nulls_last("f1"), "trial").first()
    if best is None:
        raise ValueError("no trials to refit")
    params = dict(literal_eval(best["params"]))
    return best["family"], params, train(train_df.unionByName(val_df), best["family"], params, features, label, weight)
