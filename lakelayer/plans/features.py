"""Point-in-time feature queries (survey E3-E5, N3-N5, C7, F4-F6).

Mapping of the travel-purchase data onto the test tables: ``events`` rows are
the look-ups (``event_type`` is the destination, ``value`` the looked-up
price, a ``click`` event a click, a ``purchase`` event a purchase);
``customer`` supplies the demography.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.asof import training_set
from ..operators.rolling import destination_features, user_behavior, user_features
from ..operators.sample import hash_sample, hash_split, int_bucket_sql, share, time_split
from ..sources.tables import Tables
from .registry import register

SEED = 42
CUT = "2024-01-20"


def purchases(t: Tables):
    return t.events.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("destination_id"),
        "ts",
        F.col("value").cast("decimal(12,2)").alias("price"),
        (F.col("event_type") == "click").alias("clicked"),
        (F.col("event_type") == "purchase").alias("purchased"),
    )


def demography(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("user_id"),
        (F.lit(18) + F.col("c_custkey") % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("income_bracket"),
        F.col("c_nationkey").alias("billing_state"),
        F.date_add(F.to_date(F.lit("2023-01-01")), (F.col("c_custkey") % 365).cast("int")).alias("first_login_date"),
    )


PURCHASES_SQL = """
p AS (SELECT event_id, user_id, event_type AS destination_id, ts, CAST(value AS DECIMAL(12,2)) AS price,
             event_type = 'click' AS clicked, event_type = 'purchase' AS purchased,
             epoch_us(ts) // 1000000 AS tsl FROM events)"""

BEHAVIOR_SQL = f"""
{PURCHASES_SQL},
b AS (SELECT user_id, ts,
   CASE WHEN count(*) OVER w7 > 0 THEN CAST(sum(price) OVER w7 AS DOUBLE) / count(*) OVER w7 END AS mean_price_7d,
   CAST(sum(CAST(purchased AS INTEGER)) OVER w6 AS DOUBLE) AS last_6m_purchases
 FROM p
 WINDOW w7 AS (PARTITION BY user_id ORDER BY tsl RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW),
        w6 AS (PARTITION BY user_id ORDER BY tsl RANGE BETWEEN 15552000 PRECEDING AND CURRENT ROW))"""

DEST_SQL = f"""
{PURCHASES_SQL},
d AS (SELECT destination_id, ts,
   sum(CAST(clicked AS INTEGER)) OVER w AS sum_clicks_7d, count(*) OVER w AS sum_impressions_7d
 FROM p WINDOW w AS (PARTITION BY destination_id ORDER BY tsl RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW))"""

DEMO_SQL = """
demo AS (SELECT c_custkey AS user_id, CAST(18 + c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS income_bracket,
   c_nationkey AS billing_state, CAST(DATE '2023-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS first_login_date
 FROM customer)"""


@register("user_behavior_rolling", f"WITH {BEHAVIOR_SQL.strip()} SELECT * FROM b")
def q_user_behavior(spark, sf_dir):
    """Trailing 7-day mean price and 6x30-day purchases per user."""
    return user_behavior(purchases(Tables(spark, sf_dir)))


@register("entity_popularity_7d", f"WITH {DEST_SQL.strip()} SELECT * FROM d")
def q_entity_popularity(spark, sf_dir):
    """Trailing 7-day clicks and impressions per destination."""
    return destination_features(purchases(Tables(spark, sf_dir)))


USER_FEATURES_SQL = f"""
{BEHAVIOR_SQL},
{DEMO_SQL},
uf AS (SELECT b.user_id, b.ts, b.mean_price_7d, b.last_6m_purchases, demo.age, demo.income_bracket,
   demo.billing_state, CAST(date_diff('day', demo.first_login_date, CAST(b.ts AS DATE)) AS BIGINT) AS tenure_days
 FROM b LEFT JOIN demo ON b.user_id = demo.user_id)"""


def _user_features(t: Tables):
    uf = user_features(user_behavior(purchases(t)), demography(t))
    return uf.select(
        "user_id", "ts", "mean_price_7d", "last_6m_purchases", "age", "income_bracket", "billing_state", "tenure_days"
    )


@register("user_features_tenure", f"WITH {USER_FEATURES_SQL.strip()} SELECT * FROM uf")
def q_user_features(spark, sf_dir):
    """Behaviour features + demography (left join) + tenure days."""
    return _user_features(Tables(spark, sf_dir))


@register(
    "asof_training_set",
    f"""
WITH {USER_FEATURES_SQL.strip()},
lab AS (SELECT user_id, event_type AS destination_id, ts, event_type = 'purchase' AS purchased
        FROM events WHERE {int_bucket_sql('event_id', SEED)} < {share(0.3)} AND ts < TIMESTAMP '{CUT}'),
d AS (SELECT destination_id, ts,
   sum(CAST(event_type = 'click' AS INTEGER)) OVER w AS sum_clicks_7d, count(*) OVER w AS sum_impressions_7d
 FROM (SELECT event_type AS destination_id, event_type, ts, epoch_us(ts) // 1000000 AS tsl FROM events)
 WINDOW w AS (PARTITION BY destination_id ORDER BY tsl RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)),
j1 AS (SELECT lab.*, d.sum_clicks_7d, d.sum_impressions_7d
       FROM lab ASOF LEFT JOIN d ON lab.destination_id = d.destination_id AND lab.ts >= d.ts),
j2 AS (SELECT j1.*, uf.mean_price_7d, uf.last_6m_purchases, uf.tenure_days, uf.age, uf.income_bracket, uf.billing_state
       FROM j1 ASOF LEFT JOIN uf ON j1.user_id = uf.user_id AND j1.ts >= uf.ts)
SELECT purchased, sum_clicks_7d, sum_impressions_7d, mean_price_7d, last_6m_purchases, tenure_days, age,
       income_bracket, billing_state FROM j2
""",
)
def q_asof_training_set(spark, sf_dir):
    """C7 + F4 + F6: a 30% hash sample of events before the cut are the labels;
    destination and user features are looked up as of each label's time."""
    t = Tables(spark, sf_dir)
    sampled = hash_sample(t.events, "event_id", 0.3, SEED)
    train, _ = time_split(sampled, "ts", CUT)
    labels = train.select(
        "user_id", F.col("event_type").alias("destination_id"), "ts", (F.col("event_type") == "purchase").alias("purchased")
    )
    dest = destination_features(purchases(t))
    users = _user_features(t)
    user_cols = ["mean_price_7d", "last_6m_purchases", "tenure_days", "age", "income_bracket", "billing_state"]
    return training_set(
        labels,
        [(dest, ["destination_id"], "ts", ["sum_clicks_7d", "sum_impressions_7d"]), (users, ["user_id"], "ts", user_cols)],
        "ts",
        exclude=["ts", "destination_id", "user_id"],
    )


@register(
    "hash_sample",
    f"SELECT event_id, user_id, ts FROM events WHERE {int_bucket_sql('event_id', SEED)} < {share(0.3)}",
)
def q_hash_sample(spark, sf_dir):
    """30% sample by id hash, stable under repartitioning."""
    return hash_sample(Tables(spark, sf_dir).events.select("event_id", "user_id", "ts"), "event_id", 0.3, SEED)


@register(
    "hash_split",
    f"""
SELECT event_id, event_type, CASE WHEN {int_bucket_sql('event_id', SEED)} < {share(0.8)} THEN 'train' ELSE 'test' END AS split
FROM events
""",
)
def q_hash_split(spark, sf_dir):
    """80/20 split by id hash."""
    return hash_split(Tables(spark, sf_dir).events.select("event_id", "event_type"), "event_id", 0.8, SEED)


@register(
    "time_split",
    f"""
SELECT CASE WHEN ts < TIMESTAMP '{CUT}' THEN 'train' ELSE 'test' END AS part, event_type,
       count(*) AS n, round(sum(value), 4) AS value_sum
FROM events GROUP BY ALL
""",
)
def q_time_split(spark, sf_dir):
    """rows before / from the cut date, summarised per part and type."""
    train, test = time_split(Tables(spark, sf_dir).events, "ts", CUT)

    def summary(df, name):
        return df.groupBy("event_type").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value_sum")
        ).select(F.lit(name).alias("part"), "event_type", "n", "value_sum")

    return summary(train, "train").unionByName(summary(test, "test"))


@register(
    "stratified_split",
    f"""
WITH e AS (SELECT event_id, event_type, {int_bucket_sql('event_id', SEED)} AS hb FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY hb, event_id) AS rk,
             count(*) OVER (PARTITION BY event_type) AS n FROM e)
SELECT event_id, event_type, CASE WHEN rk <= round(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM r
""",
)
def q_stratified_split(spark, sf_dir):
    """80/20 split with exact per-event-type proportions."""
    from ..operators.sample import stratified_split

    return stratified_split(Tables(spark, sf_dir).events.select("event_id", "event_type"), "event_type", "event_id", 0.8, SEED)
