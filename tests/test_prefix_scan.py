"""Distributed prefix scans: equal to the one-task window, in ranges of bounded size
however the values are spread."""

import random

import pytest
from pyspark.sql import functions as F

from lakelayer.operators import fill
from lakelayer.operators.evaluate import roc_points
from lakelayer.operators.profile import exact_quantiles
from lakelayer.operators.sample import stratified_split


@pytest.fixture()
def many_ranges(spark):
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield 16
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture()
def ranges_seen(monkeypatch):
    """The sizes of the ranges of every scan."""
    seen, plain = [], fill.by_range

    def counted(df, partition, order):
        out = plain(df, partition, order)
        seen.append(sorted(r["count"] for r in out.groupBy("_chunk").count().collect()))
        return out

    monkeypatch.setattr(fill, "by_range", counted)
    return seen


def sheets(spark, n=3000):
    rng = random.Random(2)
    rows = [("HOT" if rng.random() < 0.7 else rng.choice(["a", "b", None]), k if k else None, rng.choice([None, None, None, f"m{k}"]), rng.choice([None, k])) for k in range(n)]
    return spark.createDataFrame(rows, "g string, r long, m string, v long").repartition(5)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCANS = {
    "ffill": lambda d, chunk: fill.ffill(d, ["m", "v"], ["g"], ["r"], chunk, out=["x", "y"]),
    "bfill": lambda d, chunk: fill.bfill(d, "m", ["g"], ["r"], chunk, out="x"),
    "lag_fill": lambda d, chunk: fill.lag_fill(d, "v", ["g"], ["r"], chunk, out="x"),
    "drop_before_blank": lambda d, chunk: fill.drop_before_blank(d, "m", ["g"], ["r"], chunk),
    "running_count": lambda d, chunk: fill.running_count(d, F.col("m").isNotNull(), ["g"], ["r"], chunk),
    "running_sum": lambda d, chunk: fill.running_sum(d, ["v"], [], [F.col("r").desc()], chunk),
    "with_ordinal": lambda d, chunk: fill.with_ordinal(d, ["g"], ["r"], chunk=chunk),
}


@pytest.mark.parametrize("name", SCANS)
def test_equals_the_window_of_one_task(spark, many_ranges, ranges_seen, name):
    d = sheets(spark)
    assert rows(SCANS[name](d, fill.RANGES)) == rows(SCANS[name](d, None))
    assert len(ranges_seen[0]) > many_ranges // 2 and ranges_seen[0][-1] < 3 * sum(ranges_seen[0]) / many_ranges


def test_one_sheet_with_all_rows(spark, many_ranges, ranges_seen):
    """All rows in one sheet, their order values far from even."""
    d = spark.range(20_000).selectExpr("'s' g", "if(id < 19990, id, id * 1000000000) r", "if(id % 97 = 0, id, null) m")
    out = fill.ffill(d, "m", ["g"], ["r"], fill.RANGES, out="o")
    assert out.filter("o <> floor(if(r < 19990, r, r / 1000000000) / 97) * 97").count() == 0 and out.count() == 20_000
    sizes = out.rdd.glom().map(len).collect()
    assert max(sizes) < 0.25 * sum(sizes) and ranges_seen[0][-1] < 2 * 20_000 / many_ranges


def test_quantiles_with_one_far_value(spark, many_ranges, ranges_seen):
    d = spark.range(10_000).selectExpr("if(id = 77, 1e12, id) v")
    r = exact_quantiles(d, "v", [], [0.25, 0.5, 0.75]).first()
    got = sorted([float(k) for k in range(10_000) if k != 77] + [1e12])
    assert (r["q0"], r["q1"], r["q2"]) == (got[2499], got[4999], got[7499])
    assert ranges_seen[0][-1] < 3 * 10_000 / many_ranges


def test_scores_close_together(spark, many_ranges, ranges_seen):
    d = spark.range(5_000).selectExpr("cast(id % 3 = 0 as int) y", "0.5 + id * 1e-9 s")
    points = roc_points(d, "y", "s", digits=9).collect()
    assert len(points) == 5_000 and max(p["tpr"] for p in points) == 1.0
    p = next(p for p in points if abs(p["threshold"] - (0.5 + 4000e-9)) < 1e-10)
    assert abs(p["tpr"] - len(range(4002, 5000, 3)) / len(range(0, 5000, 3))) < 1e-6
    assert ranges_seen[0][-1] < 3 * 5_000 / many_ranges


def test_split_of_one_large_class(spark, many_ranges, ranges_seen):
    d = spark.range(6_000).selectExpr("id", "if(id % 10 = 0, 'b', 'a') y")
    n = {(r["y"], r["split"]): r["count"] for r in stratified_split(d, "y", "id").groupBy("y", "split").count().collect()}
    assert n == {("a", "train"): 4320, ("a", "test"): 1080, ("b", "train"): 480, ("b", "test"): 120}
    assert ranges_seen[0][-1] < 3 * 6_000 / many_ranges


def test_zip_and_empty(spark):
    a = spark.createDataFrame([("g", k) for k in (5, 3, 9)], "g string, x int")
    b = spark.createDataFrame([("g", k) for k in (2, 8)], "g string, y int")
    assert rows(fill.zip_rows(a, b, ["g"], ["x"], ["y"])) == [("g", 3, 2), ("g", 5, 8)]
    assert fill.ffill(sheets(spark, 10).limit(0), "m", ["g"], ["r"], fill.RANGES).count() == 0
