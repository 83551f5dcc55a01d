import collections
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lakelayer.llm import sharding
from lakelayer.llm.queries import op3_sharding


def check(rows, size_of, shards):
    by = {}
    for r in rows:
        assert r["size"] == size_of(r)
        by.setdefault(r["shard"], []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op3_sharding(spark, sf).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    check(rows, lambda r: len(docs[r["doc_id"]].encode()) + 1, 16)
    assert all(r["text_crc32"] == zlib.crc32(docs[r["doc_id"]].encode()) and r["law"] == "bytes" and r["grown_shard"] is None for r in rows)


def test_hot_key_is_split_and_even(spark):
    """A third of the rows share one text."""
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    rows = sharding.shard_records(df, shards=8, ranges_per_shard=4, oversample=8).collect()
    sums = check(rows, lambda r: len(r["text"]) + 1, 8)
    mean = sum(sums.values()) / 8
    assert len(sums) == 8 and max(sums.values()) < 1.02 * mean and min(sums.values()) > 0.98 * mean
    cuts, total, large = sharding.splitters(df.select(F.xxhash64("text").alias("__key"), F.col("doc_id").alias("__id"), sharding.size_of(F.col("text")).alias("__size")), 8, 4, 8, 2.0, 0.01)
    assert len(large) == 1
    key = df.select(F.xxhash64("text").alias("__key"), F.col("doc_id").alias("__id"), sharding.size_of(F.col("text")).alias("__size"))
    filled = key.groupBy(sharding.range_id(cuts).alias("r")).agg(F.sum("__size").alias("n")).collect()
    assert max(r["n"] for r in filled) <= 2 * total / 32 + 20


def brute(rows, shards, limit):
    """id -> (shard, slot), for texts of at most ``limit`` bytes in groups or one text a row."""
    order = sorted(rows)  # (key, id, size)
    total, end, at = sum(r[2] for r in order), 0, {}
    groups = itertools.groupby(order, key=lambda r: r[0])
    counts = collections.Counter()
    for _, own in groups:
        own = list(own)
        size = sum(r[2] for r in own)
        whole = size <= limit
        for key, ident, n in own:
            middle = end + size / 2 if whole else end + n / 2
            end += 0 if whole else n
            shard = min(int(middle * shards / total), shards - 1)
            at[ident] = (shard, counts[shard])
            counts[shard] += 1
        end += size if whole else 0
    return at


@pytest.mark.parametrize("seed", range(6))
def test_groups_stay_whole_and_equal_brute_force(spark, few_partitions, seed):
    """Groups of equal texts under the limit of 1 % of a shard, and a large one."""
    rng = random.Random(seed)
    rows, k = [], 0
    for g in range(1200):
        for _ in range(rng.choice([1, 1, 2, 10])):
            rows.append((k, f"{seed} text {g} " + "x" * (g % 37)))
            k += 1
    rows += [(k + j, f"{seed} a large group") for j in range(rng.choice([0, 900]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.xxhash64("text")).repartition(4)
    got = sharding.shard_records(df, shards=4).collect()
    keyed = [(r["key"], r["doc_id"], r["size"]) for r in got]
    total = sum(r[2] for r in keyed)
    limit = 0.01 * total / 4
    want = brute(keyed, 4, limit)
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want
    sizes, homes = collections.Counter(), collections.defaultdict(set)
    for r in got:
        sizes[r["key"]] += r["size"]
        homes[r["key"]].add(r["shard"])
    assert all(len(homes[x]) == 1 for x, n in sizes.items() if n <= limit)
    assert sum(n <= limit for n in sizes.values()) > 800


def test_messy(messy, clash, no_docs):
    rows = sharding.shard_records(messy, shards=4).collect()
    check(rows, lambda r: len((r["text"] or "").encode()) + 1, 4)
    assert len(rows) == messy.count()
    out = sharding.shard_records(clash, shards=4)
    assert out.columns == [c for c in clash.columns if c not in ("size", "shard", "slot")] + ["size", "shard", "slot"]
    assert out.count() == messy.count()
    assert sharding.shard_records(no_docs).count() == 0
