import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from lakelayer.llm import simhash
from lakelayer.llm.queries import op6_simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    runs = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints):
    """Root per fingerprint, by comparing all pairs."""
    u = sorted(set(prints))
    root = {x: x for x in u}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, x in enumerate(u):
        for y in u[k + 1 :]:
            if (x ^ y).bit_count() <= 3:
                root[find(y)] = find(x)
    return {x: find(x) for x in u}


def check(rows, texts):
    """rows: (id, fingerprint, component)."""
    prints = [fingerprint(t) for _, t in texts]
    root = classes(prints)
    least = {}
    for (i, _), p in zip(texts, prints, strict=True):
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    want = [(i, f"{p:016x}", least.get(root[p])) for (i, _), p in zip(texts, prints, strict=True)]
    assert sorted(rows, key=str) == sorted(want, key=str)


def test_query(spark, sf):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check([tuple(r) for r in op6_simhash(spark, sf).collect()], texts)


def test_messy(spark, messy, clash, no_docs):
    texts = [(r["doc_id"], r["text"]) for r in messy.collect()]
    got = simhash.near_duplicates(messy)
    check([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()], texts)
    assert simhash.near_duplicates(clash).count() == messy.count()
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.one_of_each(clash)
    assert kept.columns == clash.columns
    prints = {fingerprint(t) for _, t in texts}
    assert kept.count() == len(set(classes(prints).values()))
    assert kept.filter("doc_id = 1").count() == 1


def test_links_are_whole_and_few(spark):
    """Dense groups, hot buckets and every distance from 0 to 5."""
    rng = np.random.default_rng(7)
    prints = set()
    for _ in range(30):
        at = int(rng.integers(0, 2**63))
        prints.add(at)
        for _ in range(40):
            at ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
            prints.add(at)
    prefix = int(rng.integers(0, 2**31)) << 32
    prints |= {prefix | int(x) for x in rng.integers(0, 2**32, 1500)}  # one search key for all
    signed = [int(np.array(p, dtype=np.uint64).view(np.int64)) for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    want = classes(prints)
    groups = {frozenset(p for p in prints if want[p] == r) for r in set(want.values())}
    for split in (simhash.SPLIT, 100):  # 100: the hot bucket is cut further
        links = simhash.links(df, split)
        assert links.count() < 8 * len(prints)
        roots = {r["node"] % 2**64: r["root"] % 2**64 for r in simhash.components(links).collect()}
        got = {}
        for p in prints:
            got.setdefault(roots.get(p, p), set()).add(p)
        assert {frozenset(v) for v in got.values()} == groups


def test_components_of_long_chains(spark):
    n = 300
    edges = spark.range(n - 1).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v")).filter("u <> 99")
    roots = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert all(roots[k] == (0 if k < 100 else 100) for k in range(n) if k in roots) and len(roots) >= n - 2
