"""Writers, streaming sources and monitoring against brute force."""

import math
import os

import pandas as pd
from pyspark.sql import functions as F

from lakelayer.operators.monitor import chi2_sf, drift, violations
from lakelayer.sources.files import evolve_schema
from lakelayer.streaming.ingest import ingest


def test_evolve_schema():
    from pyspark.sql import types as T

    old = T.StructType([T.StructField("a", T.IntegerType())])
    new = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert [f.name for f in evolve_schema(old, new).fields] == ["a", "b"]
    assert isinstance(evolve_schema(old, new).fields[0].dataType, T.IntegerType)


def test_chi2_sf_closed_form(spark):
    df = spark.createDataFrame([(x, d) for x in (0.5, 3.0, 11.0, 40.0) for d in (2.0, 4.0, 6.0)], "x double, d double")
    got = df.select("x", "d", chi2_sf(F.col("x"), F.col("d")).alias("p")).collect()
    for r in got:
        k = int(r.d) // 2
        want = math.exp(-r.x / 2) * sum((r.x / 2) ** i / math.factorial(i) for i in range(k))
        assert abs(r.p - want) < 1e-9


def test_drift_matches_pandas(spark):
    rows = [("2024-01-01 10:00:00", c) for c in "aaab"] + [("2024-01-02 10:00:00", c) for c in "abbc"]
    df = spark.createDataFrame(rows, "ts string, c string").withColumn("ts", F.col("ts").cast("timestamp"))
    r = drift(df, "ts", "c", mode="consecutive").collect()
    assert len(r) == 1
    p = pd.Series({"a": 3 / 4, "b": 1 / 4, "c": 0.0})
    q = pd.Series({"a": 1 / 4, "b": 2 / 4, "c": 1 / 4})
    # current window = day 2 (q-like counts), reference = day 1
    cur, ref = q, p
    m = (cur + ref) / 2
    js = math.sqrt(0.5 * sum(v * math.log2(v / m[k]) for k, v in cur.items() if v > 0)
                   + 0.5 * sum(v * math.log2(v / m[k]) for k, v in ref.items() if v > 0))
    assert abs(r[0].js_distance - round(js, 6)) < 1e-6
    assert abs(r[0].tv_distance - 0.5) < 1e-9 and abs(r[0].l_infinity_distance - 0.5) < 1e-9


def test_violations_brute_force(spark):
    data = [(0.4, -40.0, 0.3, 0.2), (0.4, -10.0, 0.3, 0.1), (0.9, 50.0, 0.2, 0.25), (None, 100.0, None, None)]
    df = spark.createDataFrame(data, "perf double, loss double, label double, prediction double")
    r = violations(df, "perf", "loss", "label", "prediction").first()
    pv = sum(1 for p, l, *_ in data if p is not None and p < 0.5 and abs(l) > 30)
    dv = sum(1 for *_, a, b in data if a is not None and a > 0.19 and b > 0.19)
    assert (r.performance_violations, r.drift_violations, r.all_violations) == (pv, dv, pv + dv)


def test_checkpoint_dir_is_session_setting(spark):
    from lakelayer.session import ensure_checkpoint_dir

    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert os.path.isdir(spark.conf.get("spark.checkpoint.dir"))


def test_drift_baseline_missing_categories(spark):
    """Baseline categories absent from a window (and window categories absent
    from the baseline) against a brute-force computation."""
    base_rows = [("2024-01-01 00:00:00", c) for c in "aaaabbbccd"]
    cur_rows = [("2024-01-02 01:00:00", c) for c in "aabe"] + [("2024-01-03 01:00:00", c) for c in "bbbb"]
    mk = lambda rs: spark.createDataFrame(rs, "ts string, c string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = {str(r.window_start)[:10]: r for r in drift(mk(cur_rows), "ts", "c", mode="baseline", baseline=mk(base_rows)).collect()}
    base = pd.Series(list("aaaabbbccd")).value_counts()
    for day, cs in (("2024-01-02", "aabe"), ("2024-01-03", "bbbb")):
        cur = pd.Series(list(cs)).value_counts()
        cats = sorted(set(base.index) | set(cur.index))
        n = cur.reindex(cats, fill_value=0).astype(float)
        m = base.reindex(cats, fill_value=0).astype(float)
        p, q = n / n.sum(), m / m.sum()
        mid = (p + q) / 2
        js = math.sqrt(0.5 * sum(p[c] * math.log2(p[c] / mid[c]) for c in cats if p[c] > 0)
                       + 0.5 * sum(q[c] * math.log2(q[c] / mid[c]) for c in cats if q[c] > 0))
        N, M = n.sum(), m.sum()
        ec, er = (n + m) * N / (N + M), (n + m) * M / (N + M)
        chi = sum((n[c] - ec[c]) ** 2 / ec[c] + (m[c] - er[c]) ** 2 / er[c] for c in cats)
        r = got[day]
        assert abs(r.js_distance - js) < 1e-6
        assert abs(r.tv_distance - 0.5 * (p - q).abs().sum()) < 1e-6
        assert abs(r.l_infinity_distance - (p - q).abs().max()) < 1e-6
        assert abs(r.chi_squared_statistic - chi) < 1e-5
        assert r.dof == len(cats) - 1


def test_streaming_daily_windows_with_watermark(spark, tmp_path):
    """I8 streaming form: one-day tumbling windows with a watermark, read from
    a Parquet table as a stream; closed windows equal the batch counts."""
    from lakelayer.sources.tables import stream_table
    from lakelayer.streaming.ingest import daily_window_counts

    src = str(tmp_path / "ev")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    ev.write.parquet(src)
    out, ck = str(tmp_path / "win"), str(tmp_path / "win_ck")
    agg = daily_window_counts(stream_table(spark, src, "."), "ts", "1 hour").select(
        F.col("window.start").alias("day"), "n"
    )
    ingest(agg, out, ck, timeout_s=180)
    got = {r.day: r.n for r in spark.read.parquet(out).collect()}
    want = {r.day: r.n for r in ev.groupBy(F.window("ts", "1 day").start.alias("day")).count().withColumnRenamed("count", "n").collect()}
    assert got and all(want[d] == n for d, n in got.items())
    assert len(got) >= len(want) - 1  # only the last, still-open window may be missing


def test_shared_folder_is_required_off_local_mode(spark):
    import pytest

    from lakelayer.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getConf(self):  # noqa: N802
            return {}

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        conf = {}
        sparkContext = Context()  # noqa: N815

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
