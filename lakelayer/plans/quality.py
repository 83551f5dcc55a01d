"""Quality queries (survey I3-I5, L1-L4, D4, H7, H14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import RAW_TS_FORMAT
from ..operators.features import clean_orders
from ..operators.quality import (
    check_key,
    duplicate_keys,
    expect_or_drop,
    expectation_report,
    parse_flow_log,
    parse_quality_log,
)
from ..sources.tables import Tables
from .registry import register

ORDER_RULES = [
    ("user_id_valid", "o_custkey IS NOT NULL"),
    ("price_over_1000", "o_totalprice > 1000"),
    ("status_known", "o_orderstatus IN ('F', 'O')"),
]


def _orders_with_nulls(t: Tables):
    o = t.orders
    return o.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 50 == 0, F.lit(None)).otherwise(F.col("o_custkey"))
    )


@register(
    "expectation_report",
    """
WITH o AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_totalprice, o_orderstatus
           FROM orders),
c AS (SELECT count(*) FILTER (WHERE o_custkey IS NOT NULL) AS p0, count(*) FILTER (WHERE o_custkey IS NULL) AS f0,
             count(*) FILTER (WHERE o_totalprice > 1000) AS p1, count(*) FILTER (WHERE NOT (o_totalprice > 1000)) AS f1,
             count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS p2,
             count(*) FILTER (WHERE NOT (o_orderstatus IN ('F', 'O'))) AS f2,
             count(*) FILTER (WHERE o_custkey IS NULL) AS d FROM o)
SELECT 'orders' AS dataset, 'user_id_valid' AS name, p0 AS passed_records, f0 AS failed_records, d AS dropped_records FROM c
UNION ALL SELECT 'orders', 'price_over_1000', p1, f1, d FROM c
UNION ALL SELECT 'orders', 'status_known', p2, f2, d FROM c
""",
)
def q_expectation_report(spark, sf_dir):
    """Passed / failed per rule and dropped rows, one aggregate pass."""
    return expectation_report(_orders_with_nulls(Tables(spark, sf_dir)), ORDER_RULES, "orders", drop=["user_id_valid"])


def raw_orders(t: Tables):
    """Orders as raw text records, as the file source delivers them."""
    o = t.orders
    li = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.when(F.col("o_orderkey") % 77 == 0, F.lit(None)).otherwise(F.col("o_orderkey").cast("string")).alias("id"),
        F.when(F.col("o_orderkey") % 50 == 0, F.lit(None)).otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(F.col("o_orderkey") % 61 == 0, F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", RAW_TS_FORMAT))
        .alias("transaction_date"),
        F.when(F.col("o_orderkey") % 43 == 0, F.lit("n/a"))
        .otherwise(F.floor("o_totalprice").cast("string"))
        .alias("amount"),
        F.coalesce(F.col("n"), F.lit(0)).cast("string").alias("item_count"),
    )


RAW_ORDERS_SQL = """
li AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
raw AS (
  SELECT CASE WHEN o_orderkey % 77 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS id,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN o_orderkey % 61 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%m-%d-%Y %H:%M:%S') END
           AS transaction_date,
         CASE WHEN o_orderkey % 43 = 0 THEN 'n/a' ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS amount,
         CAST(coalesce(n, 0) AS VARCHAR) AS item_count
  FROM orders LEFT JOIN li ON o_orderkey = l_orderkey)"""


@register(
    "expect_or_drop",
    f"""
WITH {RAW_ORDERS_SQL.strip()}
SELECT id AS order_id, user_id, try_strptime(transaction_date, '%m-%d-%Y %H:%M:%S') AS creation_date,
       TRY_CAST(amount AS INTEGER) AS amount, TRY_CAST(item_count AS INTEGER) AS item_count
FROM raw WHERE user_id IS NOT NULL AND id IS NOT NULL
""",
)
def q_expect_or_drop(spark, sf_dir):
    """Silver orders -- rows failing either id rule are dropped,
    bad dates and amounts become NULL instead of failing the job."""
    raw = raw_orders(Tables(spark, sf_dir))
    kept = expect_or_drop(raw, [("user_id_valid", "user_id IS NOT NULL"), ("order_id_valid", "id IS NOT NULL")])
    return clean_orders(kept)


EVENT_RULES = [("value_over_5", "value > 5"), ("k_under_90", "CAST(get_json_object(props, '$.k') AS INT) < 90")]


def quality_log_record(df, group, rules, dataset):
    """Build pipeline event-log rows: per group one ``flow_progress`` JSON with
    the output row count and the expectation results (what a pipeline run
    writes; used to test :func:`parse_quality_log`)."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (_, p) in enumerate(rules):
        aggs += [F.count_if(F.coalesce(F.expr(p), F.lit(False))).alias(f"_p{i}"), F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(f"_f{i}")]
    anyfail = F.lit(False)
    for _, p in rules:
        anyfail = anyfail | ~F.coalesce(F.expr(p), F.lit(False))
    aggs.append(F.count_if(anyfail).alias("_drop"))
    g = df.withColumn("_dataset", dataset).groupBy(*group, "_dataset").agg(*aggs)
    exps = F.array(
        *[
            F.struct(
                F.lit(n).alias("name"),
                F.col("_dataset").alias("dataset"),
                F.col(f"_p{i}").alias("passed_records"),
                F.col(f"_f{i}").alias("failed_records"),
            )
            for i, (n, _) in enumerate(rules)
        ]
    )
    details = F.struct(
        F.struct(
            F.struct(F.col("_rows").alias("num_output_rows")).alias("metrics"),
            F.struct(F.col("_drop").alias("dropped_records"), exps.alias("expectations")).alias("data_quality"),
        ).alias("flow_progress")
    )
    return g.select(*group, F.to_json(details).alias("details"))


def flow_definition_record(df):
    """``flow_definition`` event-log rows, one per (id, output, inputs, type)."""
    details = F.struct(
        F.struct(
            F.col("output_dataset"),
            F.col("input_datasets"),
            F.col("flow_type"),
            F.col("schema"),
        ).alias("flow_definition")
    )
    return df.select("id", "timestamp", F.to_json(details).alias("details"))


def _event_log(t: Tables):
    ev = t.events.withColumn("day", F.to_date("ts"))
    prog = quality_log_record(ev, ["day", "event_type"], EVENT_RULES, F.concat(F.col("event_type"), F.lit("_silver")))
    prog = prog.select(
        F.concat_ws("-", F.col("event_type"), F.col("day").cast("string")).alias("id"),
        F.col("day").cast("timestamp").alias("timestamp"),
        "details",
    )
    defs = t.events.groupBy("event_type").agg(F.min("ts").alias("timestamp")).select(
        F.col("event_type").alias("id"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.concat(F.col("event_type"), F.lit("_silver")).alias("output_dataset"),
        F.array(F.concat(F.col("event_type"), F.lit("_bronze"))).alias("input_datasets"),
        F.when(F.col("event_type").isin("click", "view"), "append").otherwise("complete").alias("flow_type"),
        F.lit("event_id BIGINT, ts TIMESTAMP, value DOUBLE").alias("schema"),
    )
    return prog.unionByName(flow_definition_record(defs))


@register(
    "quality_log_metrics",
    """
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
           FROM events),
g AS (SELECT event_type || '-' || strftime(day, '%Y-%m-%d') AS id, event_type || '_silver' AS dataset,
             count(*) AS num_output_rows,
             count(*) FILTER (WHERE value > 5) AS p0, count(*) FILTER (WHERE NOT coalesce(value > 5, FALSE)) AS f0,
             count(*) FILTER (WHERE k < 90) AS p1, count(*) FILTER (WHERE NOT coalesce(k < 90, FALSE)) AS f1,
             count(*) FILTER (WHERE NOT coalesce(value > 5, FALSE) OR NOT coalesce(k < 90, FALSE)) AS dropped_records
      FROM e GROUP BY event_type, day)
SELECT id, dataset, 'value_over_5' AS name, p0 AS passed_records, f0 AS failed_records, dropped_records, num_output_rows FROM g
UNION ALL SELECT id, dataset, 'k_under_90', p1, f1, dropped_records, num_output_rows FROM g
""",
)
def q_quality_log_metrics(spark, sf_dir):
    """Expectation metrics parsed out of a JSON pipeline event log
    (the log itself is produced from ``events`` per day and type)."""
    return parse_quality_log(_event_log(Tables(spark, sf_dir)))


@register(
    "flow_log_lineage",
    """
SELECT event_type AS id, CAST(min(ts) AS TIMESTAMP) AS timestamp, event_type || '_silver' AS output_dataset,
       '["' || event_type || '_bronze"]' AS input_datasets,
       CASE WHEN event_type IN ('click', 'view') THEN 'append' ELSE 'complete' END AS flow_type
FROM events GROUP BY event_type
""",
)
def q_flow_log_lineage(spark, sf_dir):
    """L3: lineage fields of the flow-definition events of the same log."""
    return parse_flow_log(_event_log(Tables(spark, sf_dir)))


LINE_NULL_SQL = "CASE WHEN l_partkey % 100 = 0 THEN NULL ELSE l_linenumber END"


def _lines_with_null(t: Tables):
    return t.lineitem.withColumn(
        "l_linenumber", F.when(F.col("l_partkey") % 100 == 0, F.lit(None)).otherwise(F.col("l_linenumber"))
    )


@register(
    "key_check",
    f"""
WITH l AS (SELECT l_orderkey, {LINE_NULL_SQL} AS l_linenumber FROM lineitem),
k AS (SELECT l_orderkey, l_linenumber, count(*) AS n, max(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 1 ELSE 0 END) AS has_null
      FROM l GROUP BY l_orderkey, l_linenumber)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(coalesce(sum(CASE WHEN has_null = 1 THEN n END), 0) AS BIGINT) AS n_null_keys,
       count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
       coalesce(sum(CASE WHEN has_null = 1 THEN n END), 0) = 0 AND count(*) FILTER (WHERE n > 1) = 0 AS ok
FROM k
""",
)
def q_key_check(spark, sf_dir):
    """L4: primary key not NULL and unique, as one result row."""
    return check_key(_lines_with_null(Tables(spark, sf_dir)), ["l_orderkey", "l_linenumber"])


@register(
    "duplicate_keys",
    """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
)
def q_duplicate_keys(spark, sf_dir):
    """Business keys occurring more than once."""
    return duplicate_keys(Tables(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])
