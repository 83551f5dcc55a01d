"""Bronze and silver flows as Structured Streaming jobs (survey I1, I3-I6, I8).

Streams run with ``trigger(availableNow=True)``: every file present when the
run starts is processed exactly once, recorded in the checkpoint, and the
query stops -- the incremental-batch mode of a scheduled pipeline.  The sink
is Parquet (a file sink with its own commit log), so a lost executor or a
restarted run neither drops nor duplicates a file.  Silver maintenance (SCD1
upsert) reads the bronze table as a batch afterwards, so no Python callback
server (``foreachBatch``) is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Rule, expect_or_drop, holds
from ..operators.upsert import scd1
from ..sources.versions import append
from ..sources.writers import path_exists


def ingest(stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] | None = None,
           timeout_s: int | None = None) -> dict[int, dict[str, dict[str, int]]]:
    """Append a stream to a Parquet table, processing what is available
    now and stopping.  Returns the observed metrics (``DataFrame.observe``) of
    this run, by micro-batch and name, from the query's progress."""
    spark = stream.sparkSession
    w = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    if partition_by:
        w = w.partitionBy(*partition_by)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept, None)
    spark.conf.set(kept, "100000")  # the progress of every micro-batch of the run
    try:
        q = w.outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(timeout_s)
    finally:
        spark.conf.set(kept, before) if before else spark.conf.unset(kept)
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream into {target} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return {p.batchId: {n: r.asDict() for n, r in p.observedMetrics.items()} for p in q.recentProgress if p.observedMetrics}


def silver_stream(
    spark: SparkSession,
    bronze: str,
    clean: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    log: str,
    flow: str,
    warn: Sequence[Rule] = (),
    drop: Sequence[Rule] = (),
) -> None:
    """One incremental run of a bronze table into a silver one.

    The files that the bronze stream has committed since the last run are read
    once, in a stream; rules of ``warn`` and ``drop`` are counted while the rows
    pass (observed metrics), rows that fail one of ``drop`` go, ``clean`` does the
    rest.  The counts are appended to ``log``, a table of committed versions, once
    per micro-batch: flow, batch, rule, action, passed, failed."""
    rows = spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze)
    rules = [(n, p, "warn") for n, p in warn] + [(n, p, "drop") for n, p in drop]
    counts = [F.count_if(c).alias(f"{k}{i}") for i, (_, p, _) in enumerate(rules) for k, c in (("passed", holds(p)), ("failed", ~holds(p)))]
    seen = rows.observe(flow, *counts) if counts else rows
    for batch, metrics in ingest(clean(expect_or_drop(seen, drop)), target, checkpoint).items():
        m = metrics.get(flow)
        if m and any(m.values()):
            found = [(flow, batch, n, action, m[f"passed{i}"], m[f"failed{i}"]) for i, (n, _, action) in enumerate(rules)]
            df = spark.createDataFrame(found, "flow string, batch long, rule string, action string, passed long, failed long")
            append(df, log, batch=f"{flow}/{batch}")


def silver_scd1(spark: SparkSession, bronze: str, state: str, keys: list[str], seq: list[str], batch: str) -> None:
    """Latest-wins state of the bronze table, incrementally.  ``batch`` is the
    bronze column (a partition of the table) that numbers the ingest runs; only
    runs after the last applied one are read.  The state is written as a new
    version ``state/v=<run>``, whose files appear when its write commits, so a run
    that is lost half-way is done again."""
    done = applied_version(spark, state)
    rows = spark.read.parquet(bronze)
    new = rows if done is None else rows.filter(F.col(batch) > done)
    newest = new.agg(F.max(batch).alias("b")).first()["b"]
    if newest is None:
        return
    old = None if done is None else spark.read.parquet(f"{state}/v={done}")
    scd1(old, new.filter(F.col(batch) <= newest), keys, seq).write.mode("overwrite").parquet(f"{state}/v={newest}")


def applied_version(spark: SparkSession, state: str) -> int | None:
    """The last committed version of a state folder."""
    if not path_exists(spark, state):
        return None
    return spark.read.parquet(state).agg(F.max(F.col("v").cast("long")).alias("v")).first()["v"]


def daily_window_counts(stream: DataFrame, ts: str, watermark: str = "1 day") -> DataFrame:
    """I8 (streaming form): tumbling one-day windows with a watermark, so a
    window's state is dropped once it can no longer change."""
    return stream.withWatermark(ts, watermark).groupBy(F.window(ts, "1 day")).agg(F.count(F.lit(1)).alias("n"))
