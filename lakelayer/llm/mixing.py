"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, repeated up to
``copies`` times.  A document's virtual finish time is the source's cumulative
tokens, its own included, divided by the source's weight.  The mix is all
documents in the order of their finish times, cut at the time at which the
fluid schedule has served the total budget; a drained queue leaves its share
to the others, so the cut also reshares what capped sources can't take.

Hot sources: a queue is cut into buckets of the shuffle key; only per-bucket
totals are added up along a source, rows only within (source, bucket).

Defined results: NULL source is a source of its own; NULL or empty text has
size 0 and is never taken; repeated rows are queued one after the other; an
empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import key, materialize, words


def cyclic_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """One row per source (``__s``): weights by rank of the source, repeating."""
    rank = F.row_number().over(Window.orderBy("__s")) - 1
    values = F.array(*[F.lit(float(w)) for w in weights])
    return sources.withColumn("__w", F.get(values, (rank % len(weights)).cast("int")))


def fluid_time(sources: DataFrame, budget: float, copies: int) -> float:
    """Virtual time at which the fluid schedule has served ``budget``: each pass
    takes the drained sources out and reshares what they leave.  Only three
    sums reach the driver per pass; the drained set only grows, and a pass that
    adds nothing ends the loop."""
    time, drained = 0.0, -1
    while True:
        full = F.col("__total") * copies <= F.lit(time) * F.col("__w")
        r = sources.agg(
            F.sum(F.when(full, F.col("__total") * copies)).alias("served"),
            F.sum(F.when(~full, F.col("__w"))).alias("open"),
            F.count(F.when(full, 1)).alias("n"),
        ).first()
        if r["n"] == drained or not r["open"]:
            return time if r["open"] else float("inf")
        drained, time = r["n"], (budget - (r["served"] or 0)) / r["open"]


def queue(docs: DataFrame, source: str, size: str, order: Column, weights: Sequence[float], share: float, copies: int, digits: int = 3) -> DataFrame:
    """``docs`` plus __cum (the source's tokens up to and with the row),
    source_size and target."""
    df = docs.withColumns({"__s": key(F.col(source)), "__o": order}).withColumn("__b", F.substring("__o", 1, digits))
    sums = materialize(df.groupBy("__s", "__b").agg(F.sum(size).alias("__n")))
    # Rows of a source: at most 16 ** digits buckets.
    before = F.sum("__n").over(Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1))
    buckets = sums.withColumn("__before", F.coalesce(before, F.lit(0)))
    sources = materialize(cyclic_weights(sums.groupBy("__s").agg(F.sum("__n").alias("__total")), weights))
    total = sources.agg(F.sum("__total").alias("t")).first()["t"] or 0
    time = fluid_time(sources, total * share, copies)
    target = F.least(F.col("__total") * float(copies), F.col("__w") * F.lit(time))
    target = F.when(F.col("__total") == 0, 0.0).otherwise(target)
    offsets = buckets.join(sources, "__s").select("__s", "__b", "__before", F.col("__total").alias("source_size"), target.alias("target"), "__w")
    within = Window.partitionBy("__s", "__b").orderBy("__o", size).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("__within", F.sum(size).over(within))
        .join(offsets, ["__s", "__b"])
        .withColumn("__cum", F.col("__before") + F.col("__within"))
        .drop("__s", "__b", "__within", "__before")
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    copies: int = 2,
) -> DataFrame:
    """``docs`` plus size, source_size, target, n_copies, taken and finish (the
    virtual finish time of the first copy).  Sources by code point, NULL last,
    weigh ``weights``, repeating; the mix holds ``share`` of all sizes and at
    most ``copies`` of a document.  The shuffle is the MD5 digest of the id, so
    reruns agree.  Columns of these names in ``docs`` are replaced."""
    own = ["size", "source_size", "target", "weight", "n_copies", "taken", "finish"]
    df = docs.drop(*own).withColumn("size", F.size(words(F.col(text))).cast("long"))
    order = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit("")).cast("binary"))
    df = queue(df, source, "size", order, weights, share, copies)
    n = sum(((F.col("__cum") + F.col("source_size") * k) <= F.col("target")).cast("int") for k in range(copies))
    df = df.withColumns({"weight": F.col("__w"), "n_copies": n, "taken": n * F.col("size"), "finish": F.col("__cum") / F.col("__w")})
    return df.drop("__cum", "__w", "__o")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: columns of ``docs``, a row per copy taken, range-sorted by
    the copy's virtual finish time.  A document without tokens costs nothing
    and stays as one row."""
    m = mix(docs, **options)
    n = F.when(F.col("size") == 0, 1).otherwise(F.col("n_copies"))
    m = m.withColumn("__n", n).filter("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    finish = F.col("finish") + F.col("__copy") * F.col("source_size") / F.col("weight")
    return m.orderBy(finish).select(*docs.columns)


SQL = """
WITH d AS (
  SELECT doc_id, md5(coalesce(doc_id::VARCHAR, text, '')) AS o, coalesce('=' || source, '~') AS s,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
src AS (SELECT s, sum(size)::BIGINT AS total FROM d GROUP BY s),
w AS (SELECT s, total, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY s) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM src),
r AS (SELECT *, row_number() OVER (ORDER BY total / w, s) AS k,
             coalesce(sum(2 * total) OVER (ORDER BY total / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS served,
             sum(w) OVER (ORDER BY total / w DESC, s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open,
             1.5 * sum(total) OVER () AS budget FROM w),
t AS (SELECT arg_min((budget - served) / open, k) FILTER (WHERE (budget - served) / open <= 2 * total / w) AS t FROM r),
tg AS (SELECT s, total, CASE WHEN total = 0 THEN 0 ELSE least(2.0 * total, w * t) END::DOUBLE AS target FROM w, t),
c AS (SELECT d.*, sum(size) OVER (PARTITION BY s ORDER BY o, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM d)
SELECT doc_id, size, total AS source_size, target,
       (size * ((cum <= target)::INT + (cum + total <= target)::INT))::BIGINT AS taken
FROM c JOIN tg USING (s)"""
