"""One sparse vector per row: levels beyond any list, unknown and missing ones, save and load."""

from pyspark.ml.stat import Summarizer

from lakelayer.operators.clean import StepCounts
from lakelayer.operators.prep import VectorPreprocessor


def vectors(df):
    return {r["k"]: (r["features"].size, dict(zip(r["features"].toArray().nonzero()[0].tolist(), r["features"].toArray()[r["features"].toArray().nonzero()].round(6).tolist()))) for r in df.collect()}


def test_levels_unknown_and_missing(spark, tmp_path):
    train = spark.createDataFrame([(1, 1.0, "b"), (2, 3.0, "a"), (3, None, "b"), (4, 2.0, "c"), (5, 2.0, None)], "k int, x double, c string")
    rest = spark.createDataFrame([(6, None, "zzz"), (7, 2.0, None), (8, 4.0, "a")], "k int, x double, c string")
    for drop_first, b in ((False, 2), (True, 1)):
        pre = VectorPreprocessor(["x"], ["c"], drop_first).fit(train)
        path = str(tmp_path / f"pre{drop_first}")
        pre.save(spark, path)
        loaded = VectorPreprocessor.load(spark, path)
        got = vectors(loaded.transform(rest.unionByName(train)))
        std = 0.5**0.5
        size = 3 if drop_first else 4
        assert loaded.size() == size and {s for s, _ in got.values()} == {size}
        assert got[6][1] == {} and got[7][1] == {b: 1.0}  # unknown: zeros; missing: the most frequent
        assert got[8][1] == ({0: round(2 / std, 6)} if drop_first else {0: round(2 / std, 6), 1: 1.0})
        assert got[4][1] == {b + 1: 1.0}


def test_a_million_levels(spark):
    df = spark.range(1_000_000).selectExpr("id", "cast(id * 7919 % 1000003 as string) c")
    pre = VectorPreprocessor([], ["c"]).fit(df)
    assert pre.size() == 1_000_000
    some = pre.transform(df.filter("id % 100000 = 5").unionByName(spark.createDataFrame([(-1, "none")], "id long, c string")))
    rows = some.collect()
    assert all(r["features"].size == 1_000_000 and r["features"].numNonzeros() == (r["id"] >= 0) for r in rows)
    order = {c: i for i, c in enumerate(sorted(str(k * 7919 % 1000003) for k in range(1_000_000)))}
    assert all(r["c_index"] == order.get(r["c"]) and (r["id"] < 0 or r["features"].indices[0] == order[r["c"]]) for r in rows)


def test_step_counts_take_one_pass(spark):
    steps = StepCounts()
    a = steps.mark(spark.range(1000).selectExpr("id", "id % 10 g"), "read")
    b = steps.mark(a.filter("g < 5"), "small")
    c = steps.mark(b.groupBy("g").count(), "groups")
    assert [tuple(r) for r in steps.run(c).collect()] == [("read", 1000), ("small", 500), ("groups", 5)]


def test_step_counts_leave_later_model_fits_alone(spark):
    steps = StepCounts()
    steps.run(steps.mark(spark.range(10), "all"))
    df = spark.range(50).selectExpr("cast(id as double) x", "cast(id % 2 as string) c")
    out = VectorPreprocessor(["x"], ["c"]).fit(df).transform(df)
    assert out.select(Summarizer.count(out.features)).first()[0] == 50
