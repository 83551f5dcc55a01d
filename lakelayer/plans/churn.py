"""Churn bronze / silver / gold queries over the test tables.

Mapping: customers are the users, ``events`` is the click stream (event type is
the platform, the event day is the session), ``orders`` are the transactions
with the item count of each order taken from ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import RAW_TS_FORMAT
from ..operators.features import churn_features, clean_users, event_features, feature_table, order_features
from ..sources.tables import Tables
from .registry import register

AS_OF = "2024-01-31"


def raw_users(t: Tables):
    """Customers as raw text records, as the file source delivers them: one id in
    101 missing, one creation date in 89 unreadable; the last activity is the
    last order's date."""
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last"))
    key = F.col("c_custkey")
    created = F.date_add(F.to_date(F.lit("1990-01-01")), (key % 700).cast("int"))
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.when(key % 101 != 0, key.cast("string")).alias("id"),
        F.when(key % 89 == 0, "not a date").otherwise(F.date_format(created, RAW_TS_FORMAT)).alias("creation_date"),
        F.date_format("last", RAW_TS_FORMAT).alias("last_activity_date"),
        F.upper(F.split("c_name", "#")[0]).alias("firstname"),
        F.upper("c_mktsegment").alias("lastname"),
        (key % 2).cast("string").alias("gender"),
        F.when(key % 53 == 0, "n/a").otherwise((key % 7).cast("string")).alias("age_group"),
        F.when(F.col("last") < F.lit("1998-01-01").cast("timestamp"), "1").otherwise("0").alias("churn"),
        F.col("c_nationkey").alias("nation_key"),
    )


RAW_USERS_SQL = """
lo AS (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey),
su AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 89 <> 0 THEN CAST(DATE '1990-01-01' + CAST(c_custkey % 700 AS INTEGER) AS TIMESTAMP) END AS creation_date,
         CAST(CAST(last AS DATE) AS TIMESTAMP) AS last_activity_date,
         upper(substr(split_part(c_name, '#', 1), 1, 1)) || lower(substr(split_part(c_name, '#', 1), 2)) AS firstname,
         upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS lastname,
         CAST(c_custkey % 2 AS INTEGER) AS gender,
         CASE WHEN c_custkey % 53 <> 0 THEN CAST(c_custkey % 7 AS INTEGER) END AS age_group,
         CASE WHEN last < TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END::INTEGER AS churn,
         c_nationkey AS nation_key
  FROM customer LEFT JOIN lo ON o_custkey = c_custkey WHERE c_custkey % 101 <> 0)"""


def silver_users(t: Tables):
    return clean_users(raw_users(t)).withColumnRenamed("id", "user_id").withColumn("user_id", F.col("user_id").cast("long"))


@register("silver_users", f"WITH {RAW_USERS_SQL.strip()} SELECT * FROM su")
def q_silver_users(spark, sf_dir):
    """Raw user records cleaned (dates, names, int casts, NULL ids dropped)."""
    return silver_users(Tables(spark, sf_dir))


def silver_orders(t: Tables):
    items = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("item_count"))
    return (
        t.orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_totalprice").alias("amount"),
            F.coalesce(F.col("item_count"), F.lit(0)).alias("item_count"),
            F.col("o_orderdate").alias("creation_date"),
        )
    )


def gold_churn(spark, sf_dir):
    t = Tables(spark, sf_dir)
    ev = event_features(
        t.events, user="user_id", session=F.to_date("ts"), platform="event_type", ts="ts", tiebreak="event_id"
    )
    od = order_features(silver_orders(t))
    dates = {"days_since_creation": "creation_date", "days_since_last_activity": "last_activity_date"}
    out = churn_features(silver_users(t), ev, od, AS_OF, user_dates=dates)
    return out.withColumn("total_amount", F.round("total_amount", 2))


CHURN_SQL = f"""
WITH {RAW_USERS_SQL.strip()},
ev AS (
  SELECT user_id, arg_min(event_type, ts) AS platform, count(*) AS event_count,
         count(DISTINCT CAST(ts AS DATE)) AS session_count, max(ts) AS last_event
  FROM events GROUP BY user_id),
items AS (SELECT l_orderkey, count(*) AS item_count FROM lineitem GROUP BY l_orderkey),
od AS (
  SELECT o_custkey AS user_id, count(*) AS order_count, sum(o_totalprice) AS total_amount,
         CAST(sum(coalesce(item_count, 0)) AS BIGINT) AS total_item, max(o_orderdate) AS last_transaction
  FROM orders LEFT JOIN items ON o_orderkey = l_orderkey GROUP BY o_custkey)
SELECT su.*,
       ev.platform, ev.event_count, ev.session_count, ev.last_event,
       od.order_count, round(od.total_amount, 2) AS total_amount, od.total_item, od.last_transaction,
       CAST(date_diff('day', CAST(su.creation_date AS DATE), DATE '2024-01-31') AS INTEGER) AS days_since_creation,
       CAST(date_diff('day', CAST(su.last_activity_date AS DATE), DATE '2024-01-31') AS INTEGER) AS days_since_last_activity,
       CAST(date_diff('day', CAST(ev.last_event AS DATE), DATE '2024-01-31') AS INTEGER) AS days_last_event,
       CAST(date_diff('day', CAST(od.last_transaction AS DATE), DATE '2024-01-31') AS INTEGER) AS days_last_transaction
FROM su JOIN ev ON ev.user_id = su.user_id JOIN od ON od.user_id = su.user_id
"""

register("churn_features", CHURN_SQL)(gold_churn)


@register(
    "churn_feature_table",
    f"""
WITH {RAW_USERS_SQL.strip()},
ev AS (
  SELECT user_id, arg_min(event_type, ts) AS platform, count(*) AS event_count,
         count(DISTINCT CAST(ts AS DATE)) AS session_count, max(ts) AS last_event
  FROM events GROUP BY user_id),
items AS (SELECT l_orderkey, count(*) AS item_count FROM lineitem GROUP BY l_orderkey),
od AS (
  SELECT o_custkey AS user_id, count(*) AS order_count, sum(o_totalprice) AS total_amount,
         CAST(sum(coalesce(item_count, 0)) AS BIGINT) AS total_item, max(o_orderdate) AS last_transaction
  FROM orders LEFT JOIN items ON o_orderkey = l_orderkey GROUP BY o_custkey)
SELECT * FROM (
SELECT su.user_id, su.gender, su.age_group, su.churn, su.nation_key,
       ev.platform, ev.event_count, ev.session_count,
       od.order_count, round(od.total_amount, 2) AS total_amount, od.total_item,
       CAST(date_diff('day', CAST(ev.last_event AS DATE), DATE '2024-01-31') AS INTEGER) AS days_last_event,
       CAST(date_diff('day', CAST(od.last_transaction AS DATE), DATE '2024-01-31') AS INTEGER) AS days_last_transaction
       , CAST(date_diff('day', CAST(su.creation_date AS DATE), DATE '2024-01-31') AS INTEGER) AS days_since_creation
       , CAST(date_diff('day', CAST(su.last_activity_date AS DATE), DATE '2024-01-31') AS INTEGER) AS days_since_last_activity
FROM su JOIN ev ON ev.user_id = su.user_id JOIN od ON od.user_id = su.user_id)
WHERE age_group IS NOT NULL AND days_since_creation IS NOT NULL
""",
)
def churn_feature_table(spark, sf_dir):
    """identity/time columns dropped, any-NULL rows dropped."""
    return feature_table(gold_churn(spark, sf_dir), drop=["firstname", "lastname", "creation_date", "last_activity_date", "last_event", "last_transaction"])
