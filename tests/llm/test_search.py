import collections
import math
import random
import re

import numpy as np
import pytest

from lakelayer.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=20):
    """docs: (id, text) rows; items: (id, text) rows."""
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, t, collections.Counter(t)) for i, t in bags if t]
    n_docs, n_terms = len(bags), sum(len(t) for _, t, _ in bags)
    df = collections.Counter(t for _, _, c in bags for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, t, c in bags:
            m = 100 - 25 + (25 * len(t) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[q] + 1))) * ((10**9 * c[q]) // (1000 * c[q] + 12 * m)) for q in terms(text) if c[q])
            if s > 0:
                scores.append((-s, i is not None, i or 0))
        out += [(item, rank, i if known else None, -s) for rank, (s, known, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.fixture
def random_rows(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    docs = [(k, " ".join(words[min(399, int(rng.expovariate(0.02)))] for _ in range(rng.randint(0, 40)))) for k in range(3000)]
    items = [(f"q{k}", " ".join(words[min(399, int(rng.expovariate(0.02)))] for _ in range(rng.randint(1, 15)))) for k in range(25)]
    return docs, items


@pytest.mark.parametrize("block_docs, query_bytes", [(60_000, 4_000_000), (200, 400)])
def test_equals_brute_force(spark, random_rows, monkeypatch, block_docs, query_bytes):
    monkeypatch.setattr(search, "BLOCK_DOCS", block_docs)
    monkeypatch.setattr(search, "QUERY_BYTES", query_bytes)
    docs, items = random_rows
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    assert got(search.search(df, benchmark)) == brute(docs, items)


def test_windows_are_skipped(monkeypatch):
    """A block whose best documents hold a rare term reads few windows of a long list."""
    vocabulary = {b"common": 0, b"rare": 1}
    block = search.Builder(vocabulary)
    for k in range(50_000):
        block.add(k, b"common " + (b"rare rare" if k < 40 else b"other words"))
    row = block.row().to_pylist()[0]
    index = search.Block(row["payload"], row["n_docs"], row["n_terms"], 2)
    docs = index.docs
    reads = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice) and key.stop is not None:
                reads.append(key.stop - key.start)
            return super().__getitem__(key)

    index.list = lambda s: (docs[index.starts[s] : index.starts[s + 1]].view(Counted), index.gain[index.starts[s] : index.starts[s + 1]])
    none = np.zeros(0, np.int64)
    scores, ids = search.hybrid(index, np.array([0, 1]), np.array([5, 9000]), (none, none), 20)
    assert ids.tolist() == list(range(20)) and len(set(scores.tolist())) == 1
    assert 0 < sum(reads) < 500


def test_messy(spark, messy, clash, no_docs):
    items = [("a", "The cat, the MOON"), ("a", "The cat, the MOON"), ("b", None), ("c", ""), (None, "again word5 no id"), ("d", "É àb \U0001f600"), ("e", "unseen terms"), ("f", "a " * 3000)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    want = brute([(r["doc_id"], r["text"]) for r in messy.collect()], items)
    assert got(search.search(messy, benchmark)) == want
    assert got(search.search(clash.withColumnRenamed("size", "rank"), benchmark)) == want
    assert search.search(no_docs, benchmark).count() == 0
    assert search.search(messy, benchmark.limit(0)).count() == 0
