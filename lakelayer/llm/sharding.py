"""Sharding by sampled splitters.

Records are ordered by (key, id).  Size-weighted samples of that order give
quantile splitters, which cut it into fine ranges; a range that turns out
overfull is subdivided by splitters sampled inside it.  Exact range totals are
added up along the ranges, rows only within a range, and the running size
decides the shard: shards are runs of the order with near-equal bytes.

Rows with equal keys are neighbours.  A key of at most ``group_share`` of a shard
is never cut: splitters inside it move to its first row, so it lies in one range
and goes as a whole to the shard that holds its middle.  Larger keys (at most
``shards / group_share`` of them) are cut by the id.

Only splitters and the large keys reach the driver; the expected number of
samples is ``shards * ranges_per_shard * oversample``, whatever the size of the data.

Defined results: NULL text has size 1 (no bytes plus 1); NULL ids come first
among equal keys; repeated rows take neighbouring slots; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import materialize

LEAST = -(2**63)


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def drawn(slim: DataFrame, rate: Column, seed: int) -> DataFrame:
    """Rows drawn with probability size * rate, by a hash of the row."""
    u = F.pmod(F.xxhash64("__key", "__id", "__size", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    return slim.filter(u < F.col("__size") * rate)


def range_id(splitters: list[tuple[int, int]]):
    """Pandas UDF: number of splitters at or below (key, id)."""
    keys = np.array([k for k, _ in splitters], dtype=np.int64)
    ids = np.array([i for _, i in splitters], dtype=np.int64)

    @F.pandas_udf("int")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for key, ident in batches:
            k, i = key.to_numpy(np.int64), ident.to_numpy(np.int64)
            at = np.searchsorted(keys, k, side="left")
            last = np.searchsorted(keys, k, side="right")
            for row in np.flatnonzero(at < last):  # the key is split: go on by the id
                at[row] += np.searchsorted(ids[at[row] : last[row]], i[row], side="right")
            yield pd.Series(at.astype(np.int32))

    return place("__key", "__id")


def splitters(slim: DataFrame, shards: int, ranges_per_shard: int, oversample: int, overfull: float, group_share: float) -> tuple[list[tuple[int, int]], int, frozenset[int]]:
    """Sorted splitters, the total size and the keys that may be cut; overfull
    ranges are cut again until none is left that can be."""
    total = slim.agg(F.sum("__size").alias("n")).first()["n"] or 0
    if not total:
        return [], 0, frozenset()
    fine = shards * ranges_per_shard
    sums = slim.groupBy("__key").agg(F.sum("__size").alias("n")).filter(F.col("n") > group_share * total / shards)
    large = frozenset(r["__key"] for r in sums.collect())  # at most shards / group_share

    def snapped(points) -> set[tuple[int, int]]:
        return {(k, i if k in large else LEAST) for k, i in points}

    def quantiles(rows: list, pieces: int) -> list[tuple[int, int]]:
        points = sorted((r["__key"], r["__id"]) for r in rows)
        return [points[len(points) * k // pieces] for k in range(1, pieces)] if points else []

    rows = drawn(slim, F.lit(fine * oversample / total), 0).select("__key", "__id").collect()
    cuts = sorted(snapped(quantiles(rows, fine)))
    for again in range(1, 64):
        filled = slim.withColumn("__r", range_id(cuts)).groupBy("__r").agg(F.sum("__size").alias("n"), F.min(F.struct("__key", "__id")).alias("lo"), F.max(F.struct("__key", "__id")).alias("hi"))
        over = filled.filter((F.col("n") > overfull * total / fine) & (F.col("lo") != F.col("hi"))).collect()
        if not over:
            break
        # Draw at each overfull range's own rate; a draw that is empty takes the upper end.
        rates = F.create_map(*[F.lit(x) for r in over for x in (r["__r"], oversample * 2.0 * (1 << again) / r["n"])])
        hot = slim.withColumn("__r", range_id(cuts)).withColumn("__rate", F.element_at(rates, F.col("__r"))).filter("__rate IS NOT NULL")
        more: dict[int, list] = {r["__r"]: [] for r in over}
        for r in drawn(hot, F.col("__rate"), again).select("__r", "__key", "__id").collect():
            more[r["__r"]].append(r)
        new = {(r["hi"]["__key"], r["hi"]["__id"]) for r in over}
        for r in over:
            new.update(quantiles(more[r["__r"]], max(2, 2 * int(r["n"] * fine / total))))
        new = snapped(new)
        if set(cuts) >= new:
            break  # every range left is one (key, id), or one key that stays whole
        cuts = sorted(set(cuts) | new)
    return cuts, total, large


def placed(df: DataFrame, cuts: list[tuple[int, int]], total: int, shards: int, large: frozenset[int]) -> tuple[DataFrame, DataFrame]:
    """``df`` with its range and in-range running columns, and the ranges' offsets."""
    df = df.withColumn("__r", range_id(cuts))
    sums = materialize(df.groupBy("__r").agg(F.sum("__size").alias("__n"), F.count("*").alias("__rows")))
    # One row per range: a number that does not grow with the data.
    before = Window.partitionBy(F.lit(0)).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "__r",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__bytes_before"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__rows_before"),
    )
    within = Window.partitionBy("__r").orderBy("__key", "__id", "__size")
    group = Window.partitionBy("__r", "__key")
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    df = df.join(offsets, "__r")
    df = df.withColumns({"__end": F.col("__bytes_before") + F.sum("__size").over(running), "__row": F.col("__rows_before") + F.row_number().over(within) - 1})
    df = df.withColumns({"__group": F.sum("__size").over(group), "__group_end": F.max("__end").over(group)})
    whole = ~F.col("__key").isin(*large) if large else F.lit(True)
    middle = F.when(whole, F.col("__group_end") - F.col("__group") / 2.0).otherwise(F.col("__end") - F.col("__size") / 2.0)
    shard = F.least(F.floor(middle * shards / float(max(total, 1))), F.lit(shards - 1)).cast("int")
    return df.withColumn("shard", shard), offsets


def shard_records(
    df: DataFrame,
    shards: int = 16,
    text: str = "text",
    ident: str = "doc_id",
    ranges_per_shard: int = 16,
    oversample: int = 32,
    overfull: float = 2.0,
    group_share: float = 0.01,
) -> DataFrame:
    """``df`` plus size, shard (0 to ``shards`` - 1) and slot (gapless from 0 in
    every shard, in the order of the key: the text's XXH64).  Columns of these
    names in ``df`` are replaced.  The records move once, to their range."""
    columns = [c for c in df.columns if c not in ("size", "shard", "slot")]
    df = df.select(*columns).withColumns({"__key": F.xxhash64(text), "__id": F.coalesce(F.col(ident).cast("long"), F.lit(LEAST)), "__size": size_of(F.col(text))})
    slim = materialize(df.select("__key", "__id", "__size"))
    cuts, total, large = splitters(slim, shards, ranges_per_shard, oversample, overfull, group_share)
    starts, _ = placed(slim, cuts, total, shards, large)
    first = materialize(starts.groupBy("shard").agg(F.min("__row").alias("__first")))
    out, _ = placed(df, cuts, total, shards, large)
    out = out.join(F.broadcast(first), "shard")  # at most one row per shard
    out = out.withColumns({"size": F.col("__size"), "slot": (F.col("__row") - F.col("__first")).cast("long")})
    return out.select(*columns, "size", "shard", "slot")
