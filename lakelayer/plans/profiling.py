"""Profiling and preprocessing queries (survey D7, D8, N8-N14, F3, H19)."""

from __future__ import annotations

from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators.prep import Preprocessor, VectorPreprocessor
from ..operators.profile import (
    box_stats,
    class_distribution,
    correlations,
    histogram,
    linear_fit,
    outliers,
    pivot_metric,
    pos_weight,
    terciles,
    top_correlated,
    value_range,
)
from ..operators.sample import int_bucket, int_bucket_sql, share
from ..sources.tables import Tables
from ..sources.writers import staging_path
from .registry import register

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register(
    "class_distribution",
    """
SELECT quality, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS pct FROM labels GROUP BY quality
""",
)
def q_class_distribution(spark, sf_dir):
    """Label classes with their share."""
    return class_distribution(Tables(spark, sf_dir).labels, "quality")


@register(
    "pos_weight",
    """
SELECT count(*) FILTER (WHERE quality = 1) AS n_pos, count(*) FILTER (WHERE quality <> 1) AS n_neg,
       CASE WHEN count(*) FILTER (WHERE quality = 1) > 0
            THEN CAST(count(*) FILTER (WHERE quality <> 1) AS DOUBLE) / count(*) FILTER (WHERE quality = 1) END AS pos_weight
FROM labels
""",
)
def q_pos_weight(spark, sf_dir):
    """Class-imbalance weight negatives / positives."""
    return pos_weight(Tables(spark, sf_dir).labels, "quality", 1)


def _pairs_sql():
    parts = []
    for i, a in enumerate(NUM):
        for b in NUM[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 4) AS corr FROM lineitem")
    return "\nUNION ALL ".join(parts)


@register("correlations", _pairs_sql())
def q_correlations(spark, sf_dir):
    """Pairwise correlations, one aggregate pass."""
    return correlations(Tables(spark, sf_dir).lineitem, NUM, digits=4)


TOP_FEATS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey"]


@register(
    "top_correlated",
    "SELECT feature, corr, abs(corr) AS abs_corr FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 4) AS corr FROM lineitem" for c in TOP_FEATS
    )
    + ") ORDER BY abs_corr DESC, feature LIMIT 4",
)
def q_top_correlated(spark, sf_dir):
    """four features most correlated (in absolute value) with the target."""
    return top_correlated(Tables(spark, sf_dir).lineitem, TOP_FEATS, "l_extendedprice", 4, digits=4)


@register(
    "histogram",
    """
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 10)) + 1, 10) AS INTEGER) AS bin, lo, hi
      FROM lineitem, r WHERE l_extendedprice IS NOT NULL)
SELECT bin, count(*) AS n, round(any_value(lo) + (bin - 1) * ((any_value(hi) - any_value(lo)) / 10), 6) AS bin_lo
FROM b GROUP BY bin
""",
)
def q_histogram(spark, sf_dir):
    """Ten equal-width bins of the extended price."""
    li = Tables(spark, sf_dir).lineitem
    lo, hi = value_range(li, "l_extendedprice")
    return histogram(li, "l_extendedprice", lo, hi, 10)


@register(
    "box_stats",
    """
SELECT l_returnflag, count(l_extendedprice) AS n, min(l_extendedprice) AS min, max(l_extendedprice) AS max,
       quantile_disc(l_extendedprice, 0.25) AS q1, quantile_disc(l_extendedprice, 0.5) AS median,
       quantile_disc(l_extendedprice, 0.75) AS q3,
       quantile_disc(l_extendedprice, 0.25) - 1.5 * (quantile_disc(l_extendedprice, 0.75) - quantile_disc(l_extendedprice, 0.25)) AS lower_fence,
       quantile_disc(l_extendedprice, 0.75) + 1.5 * (quantile_disc(l_extendedprice, 0.75) - quantile_disc(l_extendedprice, 0.25)) AS upper_fence
FROM lineitem GROUP BY l_returnflag
""",
)
def q_box_stats(spark, sf_dir):
    """Quartiles and whisker fences per group (exact)."""
    return box_stats(Tables(spark, sf_dir).lineitem, "l_extendedprice", ["l_returnflag"])


@register(
    "outliers",
    """
WITH s AS (SELECT event_type, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, e.value FROM events e JOIN s USING (event_type)
WHERE e.value < q1 - 1.5 * (q3 - q1) OR e.value > q3 + 1.5 * (q3 - q1)
""",
)
def q_outliers(spark, sf_dir):
    """Rows outside their group's 1.5xIQR fences."""
    ev = Tables(spark, sf_dir).events.select("event_id", "event_type", "value")
    return outliers(ev, "value", ["event_type"])


@register(
    "linear_fit",
    """
SELECT 'l_quantity' AS feature, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 4) AS r2
FROM lineitem
UNION ALL
SELECT 'l_discount', round(regr_slope(l_extendedprice, l_discount), 4), round(regr_intercept(l_extendedprice, l_discount), 4),
       round(regr_r2(l_extendedprice, l_discount), 4)
FROM lineitem
""",
)
def q_linear_fit(spark, sf_dir):
    """Regression line of the target on each feature."""
    return linear_fit(Tables(spark, sf_dir).lineitem, ["l_quantity", "l_discount"], "l_extendedprice", digits=4)


def _events_with_gaps(t):
    ev = t.events
    return ev.select(
        "event_id",
        F.when(F.col("event_id") % 20 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.when(F.col("event_id") % 33 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
    )


@register(
    "impute_scale_onehot",
    f"""
WITH e AS (SELECT event_id, CASE WHEN event_id % 20 = 0 THEN NULL ELSE value END AS value,
                  CASE WHEN event_id % 33 = 0 THEN NULL ELSE event_type END AS event_type FROM events),
tr AS (SELECT * FROM e WHERE {int_bucket_sql('event_id', 7)} < {share(0.8)}),
st AS (SELECT avg(value) AS m, stddev_pop(value) AS s, mode(event_type) AS md FROM tr),
f AS (SELECT e.event_id, e.event_type AS event_type_raw, (coalesce(e.value, m) - m) / CASE WHEN s = 0 THEN 1 ELSE s END AS v,
             coalesce(e.event_type, md) AS et FROM e, st)
SELECT event_id, event_type_raw AS event_type, round(v, 6) AS value,
       CAST(et = 'error' AS INTEGER) AS event_type_error, CAST(et = 'purchase' AS INTEGER) AS event_type_purchase,
       CAST(et = 'signup' AS INTEGER) AS event_type_signup, CAST(et = 'view' AS INTEGER) AS event_type_view
FROM f
""",
)
def q_impute_scale_onehot(spark, sf_dir):
    """Mean / mode imputation, population-std scaling and
    drop-first one-hot, fitted on the training split and applied to all."""
    ev = _events_with_gaps(Tables(spark, sf_dir))
    train = ev.filter(int_bucket("event_id", 7) < share(0.8))
    pre = Preprocessor(numeric=["value"], categorical=["event_type"], drop_first=True).fit(train)
    out = pre.transform(ev)
    return out.withColumn("value", F.round("value", 6))


@register(
    "datetime_features",
    """
WITH st AS (SELECT avg(epoch(o_orderdate)) AS m, stddev_pop(epoch(o_orderdate)) AS s FROM orders)
SELECT o_orderkey, hour(o_orderdate) AS o_orderdate_hour, isodow(o_orderdate) - 1 AS o_orderdate_weekday,
       CAST(isodow(o_orderdate) >= 6 AS INTEGER) AS o_orderdate_is_weekend,
       round((epoch(o_orderdate) - m) / s, 6) AS o_orderdate_epoch
FROM orders, st
""",
)
def q_datetime_features(spark, sf_dir):
    """Datetime -> epoch (mean-imputed) -> hour, weekday (Mon=0),
    weekend flag, scaled epoch."""
    o = Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    pre = Preprocessor(datetime=["o_orderdate"]).fit(o)
    return pre.transform(o).withColumn("o_orderdate_epoch", F.round("o_orderdate_epoch", 6))


@register(
    "sparse_features",
    f"""
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_totalprice END AS price,
                  CAST(o_custkey AS VARCHAR) AS cust, CASE WHEN o_orderkey % 33 = 0 THEN NULL ELSE o_orderpriority END AS prio FROM orders),
tr AS (SELECT * FROM o WHERE {int_bucket_sql('o_orderkey', 7)} < {share(0.5)}),
st AS (SELECT avg(price) AS m, stddev_pop(price) AS s FROM tr),
lc AS (SELECT cust, row_number() OVER (ORDER BY cust) - 1 AS pos FROM (SELECT DISTINCT cust FROM tr)),
lp AS (SELECT prio, n, row_number() OVER (ORDER BY prio) - 1 AS pos FROM (SELECT prio, count(*) AS n FROM tr WHERE prio IS NOT NULL GROUP BY prio)),
md AS (SELECT pos FROM lp ORDER BY n DESC, prio LIMIT 1)
SELECT o_orderkey, round((coalesce(price, m) - m) / s, 6) AS scaled, lc.pos AS cust_index,
       CASE WHEN o.prio IS NULL THEN (SELECT pos FROM md) ELSE lp.pos END AS prio_index,
       (SELECT count(*) + 1 FROM lc) + (SELECT count(*) FROM lp) AS n_features
FROM o CROSS JOIN st LEFT JOIN lc ON lc.cust = o.cust LEFT JOIN lp ON lp.prio = o.prio
""",
)
def q_sparse_features(spark, sf_dir):
    """A price, a customer id as a category and a priority in one sparse
    vector, by a preprocessor fitted on half of the rows, saved and loaded again."""
    key = F.col("o_orderkey")
    o = Tables(spark, sf_dir).orders.select(
        "o_orderkey",
        F.when(key % 20 != 0, F.col("o_totalprice")).alias("price"),
        F.col("o_custkey").cast("string").alias("cust"),
        F.when(key % 33 != 0, F.col("o_orderpriority")).alias("prio"),
    )
    path = staging_path(spark, "preprocessor")
    VectorPreprocessor(["price"], ["cust", "prio"]).fit(o.filter(int_bucket("o_orderkey", 7) < share(0.5))).save(spark, path)
    pre = VectorPreprocessor.load(spark, path)
    first = VectorSlicer(inputCol="features", outputCol="first", indices=[0]).transform(pre.transform(o))
    scaled = F.round(F.get(vector_to_array("first"), 0), 6).alias("scaled")
    return first.select("o_orderkey", scaled, "cust_index", "prio_index", F.lit(pre.size()).cast("long").alias("n_features"))


@register(
    "terciles",
    """
WITH q AS (SELECT quantile_disc(o_totalprice, [1.0 / 3, 2.0 / 3]) AS q FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice <= q[1] THEN 1 WHEN o_totalprice <= q[2] THEN 2 ELSE 3 END AS tercile FROM orders, q
""",
)
def q_terciles(spark, sf_dir):
    """Orders cut in three by price."""
    return terciles(Tables(spark, sf_dir).orders.select("o_orderkey", "o_totalprice"), "o_totalprice").drop("o_totalprice")


@register(
    "pivot_metrics",
    """
SELECT event_type, count(*)::DOUBLE AS n, round(avg(value), 4) AS mean, round(max(value), 4) AS top FROM events GROUP BY event_type
""",
)
def q_pivot_metrics(spark, sf_dir):
    """Long metrics of the event types as one column per metric."""
    ev = Tables(spark, sf_dir).events
    one = ev.groupBy("event_type").agg(F.count("*").cast("double").alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.round(F.max("value"), 4).alias("top"))
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in ("n", "mean", "top")]))
    long = one.select("event_type", pairs.alias("m")).select("event_type", "m.*")
    return pivot_metric(long, ["event_type"], "metric", "value", ["n", "mean", "top"])
