"""A single key holding every row must still be spread over several tasks
by the time-bucketed / chunked operators (checked on the partitions of the
stage that evaluates the per-key windows)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakelayer.operators import fill
from lakelayer.operators.asof import asof_join
from lakelayer.operators.rolling import rolling


@pytest.fixture()
def no_coalesce(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def busy_partitions(df) -> int:
    return sum(1 for n in df.rdd.glom().map(len).collect() if n > 0)


def hot(spark, n=4000, days=60):
    t0 = datetime(2024, 1, 1)
    rows = [("HOT", t0 + timedelta(seconds=i * days * 86400 // n), float(i % 7)) for i in range(n)]
    return spark.createDataFrame(rows, "k string, ts timestamp, v double")


def test_rolling_spreads_a_hot_key(spark, no_coalesce):
    out = rolling(hot(spark), ["k"], "ts", 7 * 86400, {"s": ("sum", "v")})
    assert busy_partitions(out) > 1


def largest_share(df) -> float:
    sizes = df.rdd.glom().map(len).collect()
    return max(sizes) / max(sum(sizes), 1)


def test_long_frame_bounds_the_largest_partition(spark, no_coalesce):
    """A key with a third of the rows under the 180-day frame, over 60 days."""
    d = hot(spark, 3000).unionAll(spark.range(6000).selectExpr("concat('k', id) AS k", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "1.0D AS v"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        assert largest_share(rolling(d, ["k"], "ts", 180 * 86400, {"s": ("sum", "v")})) <= 0.15
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_asof_spreads_a_hot_key(spark, no_coalesce):
    d = hot(spark)
    labels = d.select("k", "ts").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 SECOND"))
    out = asof_join(labels, d.withColumnRenamed("ts", "fts"), ["k"], "ts", "fts", ["v"], bucket_secs=7 * 86400)
    assert busy_partitions(out) > 1


def test_chunked_fill_spreads_a_hot_sheet(spark, no_coalesce):
    d = spark.range(0, 20000).select(
        F.lit("sheet").alias("g"), F.col("id").alias("r"), F.when(F.col("id") % 97 == 0, F.col("id")).alias("m")
    )
    out = fill.ffill(d, "m", ["g"], ["r"], F.floor(F.col("r") / 1000), out="o")
    assert busy_partitions(out) > 1
    plain = fill.ffill(d, "m", ["g"], ["r"], None, out="o")
    assert busy_partitions(plain) == 1  # the unchunked scan is one task
