import collections
import random
import re

import numpy as np
import pytest

from lakelayer.llm import phrases

UPPER = {c: c + 32 for c in range(65, 91)}


def counts(rows):
    """lang -> phrase as a tuple -> occurrences, () for all words."""
    out = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            w = re.findall("[^ \t]+", piece)
            out[lang or "und"][()] += len(w)
            for k in range(1, 6):
                out[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return out


def brute(rows, least, top):
    out = []
    for lang, f in counts(rows).items():
        n, found = f[()], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            s, _, l, r = min(((1000 * a * n) // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((s, a, " ".join(p), l, r))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, rank, p, a, l, r, n, s) for rank, (s, a, p, l, r) in enumerate(found[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(60)] + ["É", "\x01x", "naïve", "W1"]
    out = []
    for k in range(600):
        w = [words[min(len(words) - 1, int(rng.expovariate(0.1)))] for _ in range(rng.randint(0, 60))]
        if k % 3 == 0:
            w[5:5] = ["New", "York", "City", "hall"]
        out.append((rng.choice(["en", "de", "und", None]), "".join(x + rng.choice([" ", " ", " ", "\t", ", ", "\n", "  "]) for x in w)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, rows, monkeypatch, small):
    if small:  # many bursts, spills and ranges
        for name, value in {"BURST": 16, "MEMORY": 300, "RANGE": 800, "BLOCK": 100}.items():
            monkeypatch.setattr(phrases, name, value)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    assert got(phrases.mine(df, least=8, top=50)) == brute(rows, 8, 50)


def test_trie_bursts_and_keeps_counts(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 8)
    rng = np.random.default_rng(1)
    trie, want = phrases.HatTrie(5), collections.Counter()
    for _ in range(10):
        rows = rng.zipf(1.3, (400, 5)).clip(1, 50).astype("<i4")
        rows[rng.random(400) < 0.3, 3:] = 0
        rows[:100, :2] = 1
        trie.add(rows)
        want.update(map(tuple, rows.tolist()))
    assert isinstance(trie.root.kids[1], phrases.Node) or len(trie.root.kids) > 3
    taken = collections.Counter()
    for least in (200, 200, 10**6):
        rows, counts = trie.take(least)
        assert len(rows) >= min(least, 1)
        for row, n in zip(rows.tolist(), counts.tolist(), strict=True):
            taken[tuple(row)] += n
    assert taken == want and trie.entries == 0


def test_hot_pair_spreads_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANGE", 2000)
    rng = random.Random(8)
    rows = [("en", " ".join(x for _ in range(20) for x in ("hot", "pair", f"w{rng.randint(0, 5000)}"))) for _ in range(600)]
    slim = spark.createDataFrame(rows, "lang string, text string").selectExpr("lang", "cast(text as binary) text").repartition(4)
    cuts = phrases.splitters_of(slim, 5)
    sizes = [r["n"] for r in phrases.runs(slim, cuts, 5).groupBy("range").agg({"payload": "count"}).toDF("range", "n").collect()]
    assert len(sizes) > 8
    assert got(phrases.mine(spark.createDataFrame(rows, "lang string, text string"), least=300, top=10)) == brute(rows, 300, 10)


def test_exact_beyond_64_bits(spark):
    grams = spark.createDataFrame(
        [("en", 0, "", 9 * 10**15), ("en", 1, "a", 10**13 + 1), ("en", 1, "b", 10**13 + 7), ("en", 2, "a b", 10**13 - 3)], "lang string, size int, phrase string, f long"
    )
    (r,) = phrases.collocations(grams, 100).collect()
    assert r["score"] == (1000 * (10**13 - 3) * 9 * 10**15) // ((10**13 + 1) * (10**13 + 7))


def test_messy(spark, messy, clash, no_docs):
    rows = [(r["lang"], r["text"]) for r in messy.collect()]
    assert got(phrases.mine(messy, least=2)) == brute(rows, 2, 2000)
    assert got(phrases.mine(clash, least=2)) == brute(rows, 2, 2000)
    assert phrases.mine(no_docs).count() == 0
