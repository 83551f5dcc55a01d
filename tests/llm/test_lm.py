import collections
import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from lakelayer.llm import lm
from lakelayer.llm.queries import op4_lm_score


def brute(rows, train):
    """(doc_id, text) -> n_tokens, n_known, total, base, score."""
    split = lambda t: (t or "").encode().lower().split() + [lm.END]
    word, pair, context = collections.Counter(), collections.Counter(), collections.Counter()
    for i, t in rows:
        if train(i):
            w = split(t)
            u = [lm.START, *w[:-1]]
            word.update(w)
            pair.update(zip(u, w, strict=True))
            context.update(u)
    n, v = sum(word.values()), len(word)
    out = {}
    for i, t in rows:
        w = split(t)
        p = [(word[x] + 1) / (n + v + 1) for x in w]
        s = [(pair[u, x] + lm.MASS * q) / (context[u] + lm.MASS) for u, x, q in zip([lm.START, *w[:-1]], w, p, strict=True)]
        out[i, t] = len(w), sum(word[x] > 0 for x in w), n, sum(map(math.log10, p)), sum(map(math.log10, s))
    return out


def trained(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 != 2


def compare(got, rows):
    want = sorted(((i is None, i or 0), *v) for (i, t), v in brute(rows, trained).items() for _ in range(sum(r == (i, t) for r in rows)))
    have = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got)
    assert len(want) == len(have)
    for a, b in zip(want, have, strict=True):
        assert a[:4] == b[:4]
        assert abs(a[4] - b[4]) < 1e-9 * max(1, a[1]) and abs(a[5] - b[5]) < 2e-4 * a[1]


def test_query_and_model_beats_unigrams(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op4_lm_score(spark, sf).collect()
    compare(got, rows)
    assert all(r["held_out"] == (not trained(r["doc_id"])) for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_messy_and_texts_over_several_blocks(spark, messy, no_docs, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in messy.collect()]
    for step in (lm.STEP_TOKENS, 5_000):
        monkeypatch.setattr(lm, "STEP_TOKENS", step)
        monkeypatch.setattr(lm, "STEP_BYTES", step * 4)
        compare(lm.score_texts(messy, lm.training_rows()).collect(), rows)
    assert lm.score_texts(no_docs, lm.training_rows()).count() == 0
    assert {r["score"] for r in lm.score_texts(messy, F.lit(False)).collect()} == {0.0}


def test_elias_fano_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 0), (1, 10**12), (1000, 5), (70_000, 10**9), (200_000, 10**4)):
        values = np.sort(rng.integers(0, top + 1, n)).astype(np.uint64)
        coded = lm.EliasFano.encode(values)
        assert (lm.EliasFano(coded["low"], coded["high"], coded["meta"]).decode() == values).all()
        assert 8 * (len(coded["low"]) + len(coded["high"])) <= n * (2 + max(1, math.log2(max(2, (top + 1) / max(n, 1))) + 1)) + 16


def test_trie_is_memory_mapped(tmp_path):
    rng = np.random.default_rng(2)
    n = 300
    hashes = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
    pair = np.unique(rng.integers(0, n * n, 4000))
    context, word, count = pair // n, pair % n, rng.integers(1, 50, len(pair))
    c = np.bincount(word, weights=count, minlength=n).astype(np.int64)
    u = np.bincount(context, weights=count, minlength=n).astype(np.int64)
    path = tmp_path / "trie"
    path.write_bytes(lm.Trie.build(hashes, c, u, int(c.sum()), n, context, word, count))
    trie = lm.Trie.open(str(path))
    qu, qw = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n), indexing="ij"))
    held = dict(zip(pair.tolist(), count.tolist(), strict=True))
    k = np.array([held.get(int(a) * n + int(b), 0) for a, b in zip(qu, qw, strict=True)])
    p = (c + 1) / (c.sum() + n + 1)
    want = np.log10((k + lm.MASS * p[qw]) / (u[qu] + lm.MASS))
    assert np.abs(trie.score(qu, qw) - want).max() < 2e-4
    each = 10 ** trie.score(qu, qw).reshape(n, n)
    assert (each.sum(axis=1) < 1.001).all()  # a distribution, the unknown word aside
