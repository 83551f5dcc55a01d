"""Keyed table maintenance queries (survey K1-K4, I6, I7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.upsert import change_feed, scd1_apply, update_from, upsert
from ..sources import versions
from ..sources.tables import Tables
from ..sources.writers import staging_path
from ..streaming.ingest import applied_version, silver_scd1
from .registry import register

ORDER_COLS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()


def _order_versions(t: Tables):
    """Target: orders placed before 2000; source: orders from 1999 on, with
    the 1999 ones (overlap) re-priced and re-statused -- the changed part."""
    o = t.orders
    target = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp"))
    source = o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp")).select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp"), F.lit("U"))
        .otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(100.0)).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    return target, source


@register(
    "upsert_orders",
    """
WITH src AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
         o_totalprice + 100.0 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
tgt AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL SELECT * FROM src
""",
)
def q_upsert_orders(spark, sf_dir):
    """K1: MERGE (update matched, insert unmatched) as anti-join + union."""
    target, source = _order_versions(Tables(spark, sf_dir))
    return upsert(target, source, ["o_orderkey"])


LINE_COLS = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus"
).split()


@register(
    "scd1_latest_order",
    f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in LINE_COLS if c not in ('l_orderkey', 'l_linenumber'))}) = 1
""",
)
def q_scd1(spark, sf_dir):
    """Lineitem replayed as three change batches (by ship year), applied
    one after another with latest-wins per ``(l_orderkey, l_linenumber)``,
    sequenced by ship date, ties broken by the full row."""
    li = Tables(spark, sf_dir).lineitem
    day = F.col("l_shipdate")  # plain comparisons: each batch prunes its row groups
    a, b = (F.lit(f"{y}-01-01").cast("timestamp") for y in (1997, 1999))
    batches = [li.filter(day < a), li.filter((day >= a) & (day < b)), li.filter(day >= b)]
    state = scd1_apply(batches, ["l_orderkey", "l_linenumber"], ["l_shipdate"], checkpoint_every=2)
    return state.select(*li.columns)


@register(
    "change_feed",
    """
WITH o AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'),
n AS (SELECT o_orderkey, o_custkey, o_orderstatus,
             CASE WHEN o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2000-01-01' THEN o_totalprice + 1
                  ELSE o_totalprice END AS o_totalprice,
             o_orderdate, o_orderpriority
      FROM orders WHERE NOT (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01'))
SELECT n.*, 'insert' AS _change_type FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
UNION ALL SELECT o.*, 'delete' FROM o WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)
UNION ALL SELECT o.*, 'update_preimage' FROM o JOIN n USING (o_orderkey) WHERE o.o_totalprice <> n.o_totalprice
UNION ALL SELECT n.*, 'update_postimage' FROM o JOIN n USING (o_orderkey) WHERE o.o_totalprice <> n.o_totalprice
""",
)
def q_change_feed(spark, sf_dir):
    """Insert / delete / update pre- and post-images between two versions
    of ``orders``: the old version ends before 2001 (later orders are
    inserts), the new one has lost the pending pre-1996 orders (deletes) and
    re-prices urgent orders from 2000 on (updates)."""
    o = Tables(spark, sf_dir).orders
    old = o.filter(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp"))
    gone = (F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp"))
    repriced = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp"))
    new = o.filter(~gone).withColumn(
        "o_totalprice", F.when(repriced, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return change_feed(old, new, ["o_orderkey"]).select(*ORDER_COLS, "_change_type")


@register(
    "label_backfill",
    """
SELECT d.doc_id, CAST(d.n_chars > 2000 AS INTEGER) AS prediction,
       CASE WHEN l.doc_id IS NOT NULL THEN l.quality ELSE NULL END AS label
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""",
)
def q_label_backfill(spark, sf_dir):
    """The inference log's label column is filled from the label
    table where the id matches; other rows keep their (NULL) label."""
    t = Tables(spark, sf_dir)
    log = t.documents.select(
        "doc_id", (F.col("n_chars") > 2000).cast("int").alias("prediction"), F.lit(None).cast("int").alias("label")
    )
    src = t.labels.select("doc_id", F.col("quality").alias("label"))
    return update_from(log, src, ["doc_id"], ["label"])


@register(
    "create_or_upsert_roundtrip",
    """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 5 = 0 THEN CASE WHEN o_orderkey % 10 = 0 THEN '01' END
            ELSE CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE lpad(CAST(o_orderkey % 3 AS VARCHAR), 2, '0') END END AS kind,
       CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS amount
FROM orders
""",
)
def q_create_or_upsert(spark, sf_dir):
    """K2/K5/A10: two keyed writes into a partitioned table -- NULL partitions, text
    partition values with leading zeros, keys that move to another partition."""
    o = Tables(spark, sf_dir).orders
    key = F.col("o_orderkey")
    first = o.select(key.alias("order_id"), F.when(key % 3 != 0, F.lpad((key % 3).cast("string"), 2, "0")).alias("kind"), F.col("o_totalprice").alias("amount"))
    second = o.filter(key % 5 == 0).select(key.alias("order_id"), F.when(key % 10 == 0, "01").alias("kind"), (F.col("o_totalprice") + 1).alias("amount"))
    path = staging_path(spark, "upsert-roundtrip")
    for part in (first, second):
        versions.create_or_upsert(part, path, ["order_id"], partition_by=["kind"])
    return versions.read(spark, path)


@register(
    "scd1_incremental",
    """
SELECT o_orderkey % 1000 AS slot, arg_max(o_orderkey, o_orderkey) AS order_id, arg_max(o_totalprice, o_orderkey) AS amount
FROM orders GROUP BY 1
""",
)
def q_scd1_incremental(spark, sf_dir):
    """Two ingest runs into a bronze table; the second silver run reads only
    the second run's rows and the state it found."""
    o = Tables(spark, sf_dir).orders
    rows = o.select((F.col("o_orderkey") % 1000).alias("slot"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"))
    bronze, state = staging_path(spark, "scd1-bronze"), staging_path(spark, "scd1-state")
    for run, part in ((1, rows.filter("order_id % 2 = 1")), (2, rows.filter("order_id % 2 = 0"))):
        part.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(bronze)
        silver_scd1(spark, bronze, state, ["slot"], ["order_id"], "run")
    return spark.read.parquet(f"{state}/v={applied_version(spark, state)}").select("slot", "order_id", "amount")


@register(
    "table_versions",
    """
WITH c AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_custkey % 3 AS part FROM customer),
o AS (SELECT o_custkey AS id, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT 0 AS version, id, name, balance, NULL::BIGINT AS n_orders FROM c WHERE part = 0
UNION ALL SELECT 3, id, name, balance, NULL FROM c
UNION ALL SELECT 4, id, NULL, NULL, n_orders FROM o
""",
)
def q_table_versions(spark, sf_dir):
    """A snapshot, two appends with a column list (one of them
    repeated under its batch's name), an overwrite that adds a column and keeps the
    old ones; three of the versions read back."""
    t = Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    root = staging_path(spark, "versions")
    versions.overwrite(c.filter("id % 3 = 0"), root)
    versions.append(c.filter("id % 3 = 1").select("balance", "name", "id", F.lit(1).alias("more")), root, ["id", "name", "balance"])
    for _ in range(2):
        versions.append(c.filter("id % 3 = 2").select("name", "id", "balance"), root, ["id", "name", "balance"], batch="rest")
    versions.append(c.filter("id < 0"), root)
    versions.overwrite(t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n_orders")), root, merge_schema=True)
    parts = [versions.read(spark, root, v).withColumn("version", F.lit(v)) for v in (0, 3, 4)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2], allowMissingColumns=True).select("version", "id", "name", "balance", "n_orders")


@register(
    "overwrite_partitions",
    """
SELECT o_orderkey AS id, o_orderstatus AS status, year(o_orderdate)::INTEGER AS year,
       CASE WHEN year(o_orderdate) IN (1996, 1997) AND o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS price
FROM orders WHERE NOT (year(o_orderdate) IN (1996, 1997) AND o_orderstatus = 'F' AND o_orderkey % 2 = 0)
""",
)
def q_overwrite_partitions(spark, sf_dir):
    """A table partitioned by status and year; a second write replaces the
    partitions that it has, and no other."""
    o = Tables(spark, sf_dir).orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price")
    )
    root = staging_path(spark, "partitions")
    versions.overwrite(o, root, ["status", "year"])
    part = o.filter("year IN (1996, 1997) AND status = 'F' AND id % 2 <> 0").withColumn("price", F.col("price") * 2)
    versions.overwrite(part, root, ["status", "year"], dynamic=True)
    return versions.read(spark, root)


@register(
    "feature_table_merge",
    """
SELECT o_custkey AS user_id, count(*) AS n_orders, max(o_orderdate) AS last_order,
       (SELECT count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01') > 0 AS rejected
FROM orders GROUP BY 1
""",
)
def q_feature_table_merge(spark, sf_dir):
    """K5/L4: features per user, first of the orders before 2000, then those of the
    users with later ones merged by key; a write with repeated keys is rejected and
    leaves the table as it is."""
    o = Tables(spark, sf_dir).orders

    def features(rows):
        return rows.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("n_orders"), F.max("o_orderdate").alias("last_order"))

    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp")
    root = staging_path(spark, "features")
    versions.create_or_upsert(features(o.filter(~late)), root, ["user_id"], unique_keys=True)
    changed = o.join(o.filter(late).select("o_custkey").distinct(), "o_custkey", "left_semi")
    versions.create_or_upsert(features(changed), root, ["user_id"], unique_keys=True)
    twice = features(o.filter(late))
    try:
        versions.create_or_upsert(twice.unionAll(twice), root, ["user_id"], unique_keys=True)
        rejected = False
    except versions.KeyCheckFailed:
        rejected = True
    return versions.read(spark, root).withColumn("rejected", F.lit(rejected))
