"""Edge rules and invariants of the custom operators on small fixtures:
chunked scans equal unchunked ones, bucketed windows / as-of equal brute
force, upsert and SCD1 rules, report parsers on hand-made sheets."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakelayer.operators import fill
from lakelayer.operators.asof import asof_join
from lakelayer.operators.clean import keep_first, two_level_counts
from lakelayer.operators.rolling import rolling, rolling_sliding
from lakelayer.operators.upsert import DuplicateSourceKeys, change_feed, scd1, upsert


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def seq(spark):
    rnd = random.Random(3)
    data = []
    for g in ("a", "b"):
        for i in range(400):
            marker = f"m{i}" if rnd.random() < 0.05 else None
            val = None if rnd.random() < 0.3 else rnd.randint(0, 9)
            data.append((g, i, marker, val))
    return spark.createDataFrame(data, "g string, r long, marker string, v int")


@pytest.mark.parametrize("op", ["ffill", "bfill", "lag_fill"])
def test_chunked_scans_equal_plain(seq, op):
    fn = getattr(fill, op)
    col = "marker" if op != "lag_fill" else "v"
    plain = fn(seq, col, ["g"], ["r"], None, out="o")
    chunked = fn(seq, col, ["g"], ["r"], F.floor(F.col("r") / 37), out="o")
    assert rows(plain.select("g", "r", "o"), "g", "r") == rows(chunked.select("g", "r", "o"), "g", "r")


def test_chunked_next_and_running_count(seq):
    a = fill.with_next(seq, "v", ["g"], ["r"], None, "n").select("g", "r", "n")
    b = fill.with_next(seq, "v", ["g"], ["r"], F.floor(F.col("r") / 29), "n").select("g", "r", "n")
    assert rows(a, "g", "r") == rows(b, "g", "r")
    c1 = fill.running_count(seq, F.col("v").isNull(), ["g"], ["r"], None).select("g", "r", "block_id")
    c2 = fill.running_count(seq, F.col("v").isNull(), ["g"], ["r"], F.floor(F.col("r") / 50)).select("g", "r", "block_id")
    assert rows(c1, "g", "r") == rows(c2, "g", "r")


def test_lag_fill_is_one_step(spark):
    df = spark.createDataFrame([("s", 1, 5), ("s", 2, None), ("s", 3, None), ("s", 4, 7)], "g string, r int, v int")
    out = fill.lag_fill(df, "v", ["g"], ["r"])
    assert [r.v for r in out.orderBy("r").collect()] == [5, 5, None, 7]


def test_rolling_bucketed_equals_plain(spark):
    rnd = random.Random(5)
    t0 = datetime(2024, 1, 1)
    data = [(rnd.choice("xyz"), t0 + timedelta(seconds=rnd.randint(0, 40 * 86400)), float(rnd.randint(1, 9))) for _ in range(600)]
    data += [("x", data[0][1], None), ("z", t0, None)]  # same-second peer; a frame with no value
    df = spark.createDataFrame(data, "k string, ts timestamp, p double")
    want = rolling_sliding(df, ["k"], "ts", 7 * 86400, {"s": F.sum("p"), "n": F.count(F.lit(1)), "c": F.count("p")})
    for bucket in (None, 86400, 3 * 86400):
        got = rolling(df, ["k"], "ts", 7 * 86400, {"s": ("sum", "p"), "n": ("count", None), "c": ("count", "p")}, bucket)
        assert rows(want, "k", "ts", "p", "s", "n") == rows(got, "k", "ts", "p", "s", "n")


def test_asof_equals_brute_force(spark):
    rnd = random.Random(9)
    t0 = datetime(2024, 1, 1)
    feats = [(k, t0 + timedelta(hours=h), float(h)) for k in "ab" for h in sorted(rnd.sample(range(0, 24 * 40), 60))]
    labels = [(i, rnd.choice("abc"), t0 + timedelta(hours=rnd.randint(-5, 24 * 45))) for i in range(200)]
    labels.append((999, "a", feats[0][1]))  # equal timestamp matches
    f = spark.createDataFrame(feats, "k string, fts timestamp, x double")
    lab = spark.createDataFrame(labels, "id int, k string, ts timestamp")
    got = {r.id: r.x for r in asof_join(lab, f, ["k"], "ts", "fts", ["x"], bucket_secs=3 * 86400).collect()}
    for i, k, ts in labels:
        cands = [(ft, x) for kk, ft, x in feats if kk == k and ft <= ts]
        want = max(cands)[1] if cands else None
        assert got[i] == want, (i, k, ts)


def test_keep_first_paths_agree_and_nulls(spark):
    data = [(1, "b", 3.0), (1, None, 5.0), (1, "a", None), (2, "z", 1.0), (2, "z", 2.0)]
    df = spark.createDataFrame(data, "k int, s string, x double")
    fast = keep_first(df, ["k"], [("x", False), ("s", True)])
    salted = keep_first(df, ["k"], [("s", False), ("x", False)])
    assert rows(fast, "k") == [(1, None, 5.0), (2, "z", 2.0)]
    # descending text: NULLs last -> 'b' first for key 1
    assert rows(salted, "k") == [(1, "b", 3.0), (2, "z", 2.0)]


def test_two_level_counts_null_key(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, "y"), (3, "CO", "x"), (4, "CO", "x")], "id int, c string, s string")
    out = rows(two_level_counts(df, "c", "s", "id"), "c", "s", "customer_count_c")
    assert (None, 2, None, None) in out and (None, None, "x", 1) in out and ("CO", 2, "x", 2) in out


def test_upsert_rules(spark):
    tgt = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    src = spark.createDataFrame([(2, "B"), (3, "c"), (None, "N")], "k int, v string")
    out = rows(upsert(tgt, src, ["k"]), "k", "v")
    assert out == [(None, "N"), (None, "n"), (1, "a"), (2, "B"), (3, "c")]
    assert rows(upsert(upsert(tgt, src, ["k"], null_safe=True), src, ["k"], null_safe=True), "k", "v") == rows(
        upsert(tgt, src, ["k"], null_safe=True), "k", "v"
    )
    dup = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    with pytest.raises(DuplicateSourceKeys):
        upsert(tgt, dup, ["k"])


def test_scd1_batches_equal_all(spark):
    rnd = random.Random(1)
    data = [(rnd.randint(1, 20), rnd.randint(1, 50), rnd.randint(0, 3)) for _ in range(300)]
    df = spark.createDataFrame(data, "k int, seq int, v int")
    parts = [df.filter(F.col("seq") % 3 == i) for i in range(3)]
    state = None
    for p in parts:
        state = scd1(state, p, ["k"], ["seq"])
    assert rows(state, "k") == rows(scd1(None, df, ["k"], ["seq"]), "k")


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "C"), (4, "d")], "k int, v string")
    out = set(rows(change_feed(old, new, ["k"]), "k"))
    assert out == {(1, "a", "delete"), (3, "c", "update_preimage"), (3, "C", "update_postimage"), (4, "d", "insert")}


def test_global_order_scan_runs_in_chunks(spark):
    """The chunked scan must not need a single-partition window over the
    whole input: its plan partitions the big side by (key, chunk)."""
    df = spark.range(0, 1000).select(F.lit("s").alias("g"), F.col("id").alias("r"), F.when(F.col("id") % 10 == 0, F.col("id")).alias("m"))
    plan = fill.ffill(df, "m", ["g"], ["r"], F.floor(F.col("r") / 100), out="o")._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan


def test_rolling_many_frames_equal_sliding(spark):
    from lakelayer.operators.rolling import rolling_many

    rnd = random.Random(8)
    t0 = datetime(2024, 1, 1)
    data = [(rnd.choice("ab"), t0 + timedelta(seconds=rnd.randint(0, 60 * 86400)), rnd.randint(0, 5)) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, ts timestamp, p int")
    got = rolling_many(df, ["k"], "ts", {3 * 86400: {"s3": ("sum", "p")}, 20 * 86400: {"s20": ("sum", "p"), "n20": ("count", None)}})
    a = rolling_sliding(df, ["k"], "ts", 3 * 86400, {"s3": F.sum("p")})
    want = rolling_sliding(a, ["k"], "ts", 20 * 86400, {"s20": F.sum("p"), "n20": F.count(F.lit(1))})
    cols = ["k", "ts", "p", "s3", "s20", "n20"]
    assert rows(got.select(*cols), *cols) == rows(want.select(*cols), *cols)


def test_zip_rows_observe_and_classify(spark):
    from pyspark.sql import types as T

    from lakelayer.operators.fill import zip_rows
    from lakelayer.operators.prep import classify_columns
    from lakelayer.operators.quality import expect

    a = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a")], "g string, r int, x string")
    b = spark.createDataFrame([("s", 10, 0.5), ("s", 20, 0.7)], "g string, k int, tint double")
    z = rows(zip_rows(a, b, ["g"], ["r"], ["k"]), "r")
    assert z == [("s", 1, "a", 10, 0.5), ("s", 2, "b", 20, 0.7)]
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    checked, report = expect(df, [("v_present", "v IS NOT NULL"), ("v_big", "v > 2")], "d")
    assert checked.count() == 3
    assert {r.name: (r.passed_records, r.failed_records) for r in report.collect()} == {"v_present": (2, 1), "v_big": (1, 2)}
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                           T.StructField("c", T.TimestampNTZType()), T.StructField("d", T.BooleanType())])
    assert classify_columns(schema, {"a": "categorical"}) == {
        "numeric": [], "categorical": ["a", "b"], "datetime": ["c"], "boolean": ["d"]}


def test_text_helpers(spark):
    from lakelayer.functions.text import normalize_text, standardize_phone, text_equals_ci_ai

    df = spark.createDataFrame([("Tráfico",), ("Ñandú Ölçer",), (None,), ("Việt Nam",), ("Ἀθῆναι",), ("e\u0301a\u0323",)], "s string")
    got = [tuple(r) for r in df.select(normalize_text("s"), text_equals_ci_ai("s", "trafico")).collect()]
    assert got[0] == ("trafico", True)
    assert [g[0] for g in got[1:]] == ["nandu olcer", None, "viet nam", "αθηναι", "ea"]
    ph = spark.createDataFrame([("(+57) 300-123 4567 ext 89 012",), ("",), (None,), ("١٢٣4",)], "p string")
    out = [r[0] for r in ph.select(standardize_phone("p")).collect()]
    assert out[:3] == ["(573)-001-234-56789", "()---", None] and out[3] == "(١٢٣)-4--"


def test_exact_quantiles_match_sorted_rank(spark):
    import math

    from lakelayer.operators.profile import exact_quantiles

    rnd = random.Random(4)
    data = [("hot", 7.0) for _ in range(300)] + [("hot", float(rnd.randint(0, 50))) for _ in range(200)]
    data += [("cold", float(rnd.randint(-5, 5))) for _ in range(37)] + [("cold", None)]
    df = spark.createDataFrame(data, "g string, v double")
    qs = [0.1, 0.25, 0.5, 1 / 3, 0.75, 0.9, 1.0]
    for groups in (["g"], []):
        got = exact_quantiles(df, "v", groups, qs).collect()
        for r in got:
            vals = sorted(v for g, v in data if v is not None and (not groups or g == r["g"]))
            assert r["n"] == len(vals) and r["min"] == vals[0] and r["max"] == vals[-1]
            for i, q in enumerate(qs):
                assert r[f"q{i}"] == vals[max(math.ceil(q * len(vals)), 1) - 1]


def test_small_samples_are_not_empty(spark):
    from lakelayer.operators.sample import hash_sample

    ids = spark.range(1_000_000).withColumnRenamed("id", "k")
    for f in (0.0004, 0.3):
        n = hash_sample(ids, "k", f).count()
        assert abs(n - f * 1_000_000) <= 0.05 * f * 1_000_000


def test_null_keys(spark):
    from pyspark.sql import functions as F

    from lakelayer.operators.asof import asof_join
    from lakelayer.operators.fill import ffill
    from lakelayer.operators.monitor import drift
    from lakelayer.operators.profile import box_stats, outliers
    from lakelayer.operators.sample import stratified_split

    left = spark.createDataFrame([(None, 20), (1, 20)], "k long, t long").withColumn("t", F.timestamp_seconds("t"))
    right = spark.createDataFrame([(None, 10, "x"), (1, 10, "y")], "k long, t long, f string").withColumn("t", F.timestamp_seconds("t"))
    assert {(r["k"], r["f"]) for r in asof_join(left, right, ["k"], "t").collect()} == {(None, None), (1, "y")}

    rows = spark.createDataFrame([(None, i, "m0" if i == 0 else None) for i in range(6)], "p string, i long, v string")
    assert {r["v"] for r in ffill(rows, "v", ["p"], ["i"], chunk=F.floor(F.col("i") / 2)).collect()} == {"m0"}

    cls = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(400)], "c string, k long")
    got = {(r["c"], r["split"]): r["count"] for r in stratified_split(cls, "c", "k").groupBy("c", "split").count().collect()}
    assert got == {("a", "train"): 160, ("a", "test"): 40, (None, "train"): 160, (None, "test"): 40}

    v = spark.createDataFrame([(None, float(x)) for x in (1, 2, 3, 4, 100)] + [("a", 1.0)], "g string, v double")
    assert {r["g"] for r in box_stats(v, "v", ["g"]).collect()} == {None, "a"}
    assert [r["v"] for r in outliers(v, "v", ["g"]).collect()] == [100.0]

    days = spark.createDataFrame([(d, c) for d in ("2024-01-01", "2024-01-02") for c in ("a", None, None)], "d string, c string").withColumn("d", F.to_timestamp("d"))
    for mode in ("consecutive", "baseline"):
        r = drift(days, "d", "c", mode=mode).orderBy("window_start").collect()[-1]
        assert (r["js_distance"], r["tv_distance"], r["dof"]) == (0.0, 0.0, 1)


def test_chi2_tail_converges(spark):
    from pyspark.sql import functions as F

    from lakelayer.operators.monitor import chi2_sf

    got = [r[0] for r in spark.createDataFrame([(3.841458821, 1.0), (1e6, 1e6), (4e6, 4e6), (0.0, 3.0)], "s double, d double").select(chi2_sf(F.col("s"), F.col("d"))).collect()]
    assert abs(got[0] - 0.05) < 1e-9 and abs(got[3] - 1) < 1e-12
    for g, n in zip(got[1:3], (1e6, 4e6), strict=True):  # Q(a, a) = 1/2 - 1 / (3 sqrt(2 pi a)) + O(a ** -1.5)
        assert abs(g - (0.5 - 1 / (3 * (2 * 3.141592653589793 * n / 2) ** 0.5))) < 1e-6
