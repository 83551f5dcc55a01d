import collections
import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lakelayer.llm import toxicity
from lakelayer.llm.queries import op9_toxicity


def labelled(spark, n=1500, seed=3):
    rng = random.Random(seed)
    plain = [a + b for a in "ba ce di fo gu".split() for b in "la me ni po ru ta ve".split()]
    rows, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        w = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        if bad:
            for _ in range(max(2, len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(["vile", "rotten", "hateful"])
        rows.append((i, " ".join(w), "x"))
        labels.append((i, 1, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows(spark):
    docs, labels = labelled(spark)
    got = toxicity.score(docs, labels, toxicity.learnt_rows()).join(labels, "doc_id").filter(~toxicity.learnt_rows()).collect()
    assert len(got) > 200 and sum(r["predicted"] != r["toxic"] for r in got) <= 0.02 * len(got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_held_out_labels_are_not_read(spark):
    docs, labels = labelled(spark, 400)
    turned = labels.withColumn("toxic", F.when(toxicity.learnt_rows(), F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.score(docs, x, toxicity.learnt_rows()).collect()} for x in (labels, turned))
    assert a == b


def model_of(spark, rows):
    """The model of (text, toxic) rows."""
    return toxicity.expressions(*toxicity.counts(spark.createDataFrame(rows, "__text string, toxic int")))


def test_rare_expressions_weigh_nothing(spark):
    words, pairs = model_of(spark, [(f"common words here {'once' + str(i)} {'bad' if i % 2 else 'fine'}", i % 2) for i in range(200)])
    assert min(words["bad"]) > 1 and max(words["fine"]) < -1
    assert "common" not in words and not any(w.startswith("once") for w in words)
    assert all("bad" in p or "fine" in p for p in pairs)


def brute(rows):
    """Log ratios of the model by its formulas."""
    d = toxicity.DISCOUNT
    n, nn = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(lambda: [0, 0])
    for text, y in rows:
        w = text.split()
        for x in set(w):
            n[x][y] += 1
        for p in set(zip(["", *w], w)):
            nn[p][y] += 1
    cont = collections.Counter(w for _, w in nn)
    t = [sum(c[y] for c in n.values()) for y in (0, 1)]
    k = [sum(c[y] > 0 for c in n.values()) for y in (0, 1)]

    def gain(c, t):
        return sum(c[y] * math.log(c[y] * sum(t) / (sum(c) * t[y])) for y in (0, 1) if c[y])

    p = {w: [(max(c[y] - d, 0) + d * k[y] * cont[w] / len(nn)) / t[y] for y in (0, 1)] for w, c in n.items()}
    words = {w: math.log(p[w][1] / p[w][0]) for w, c in n.items() if gain(c, t) >= math.log(len(n) / toxicity.CHANCE)}
    pairs = {}
    for (u, w), c in nn.items():
        own = [v for (x, _), v in nn.items() if x == u]
        tu = [sum(v[y] for v in own) for y in (0, 1)]
        if gain(c, tu) >= math.log(len(nn) / toxicity.CHANCE):
            q = [(max(c[y] - d, 0) + d * sum(v[y] > 0 for v in own) * p[w][y]) / tu[y] if tu[y] else p[w][y] for y in (0, 1)]
            pairs[u, w] = math.log(q[1] / q[0])
    least = math.log(toxicity.LEAST_FACTOR)
    return {w: r for w, r in words.items() if abs(r) >= least}, {x: r for x, r in pairs.items() if abs(r) >= least}


def test_model_equals_its_formulas(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(25)]
    rows = []
    for i in range(480):
        y = int(i % 4 == 0)
        w = [rng.choice(words[:20] if y else words[3:]) for _ in range(rng.randint(0, 14))]
        rows.append((" ".join(w + (["w3", "w4"] if y and rng.random() < 0.6 else ["w4", "w3"])), y))
    got, want = model_of(spark, rows), brute(rows)
    assert len(got[0]) > 3 and got[1]
    for a, b in zip(got, want):
        assert a.keys() == b.keys()
        assert all(abs(a[x][0] - b[x]) < 1e-9 for x in a)
    # Without one text that holds a word, only its own count changes.
    for y in (0, 1):
        for w, r in got[0].items():
            less = next(i for i, (t, c) in enumerate(rows) if c == y and w in t.split()) if any(c == y and w in t.split() for t, c in rows) else None
            if less is not None and r[1 + y]:
                assert abs(r[1 + y] - r[0]) < 0.5 and (r[1 + y] > r[0] if y == 0 else r[1 + y] < r[0])


@pytest.mark.parametrize("seed", range(11))
def test_few_toxic_labels(spark, few_partitions, seed):
    """Six toxic rows of 600, held-out ones among them, hold one word three times."""
    rng = random.Random(seed)
    plain = [a + b for a in "ba ce di fo gu".split() for b in "la me ni po ru ta ve".split()]
    rows = [(k, [rng.choice(plain) for _ in range(rng.randint(40, 90))]) for k in range(600)]
    bad = {k for k, _ in rows if k % 100 == seed}
    for k, w in rows:
        if k in bad:
            for at in rng.sample(range(len(w)), 3):
                w[at] = "vile"
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k in bad)) for k, _ in rows], "doc_id long, toxic int")
    got = toxicity.score(docs, labels, toxicity.learnt_rows()).filter("predicted = 1").collect()
    assert {r["doc_id"] for r in got} == bad


def test_words_with_marks(spark):
    """Words learnt with combining marks are found with them."""
    marked = ["हिंदी", "কৃষ্ণ", "ที่นี่", "قُرْآن", unicodedata.normalize("NFD", "été")]
    docs, labels = labelled(spark)
    for bad, w in zip(("vile", "rotten", "hateful"), marked):
        docs = docs.withColumn("text", F.regexp_replace("text", bad, w))
    got = toxicity.score(docs, labels, toxicity.learnt_rows()).join(labels, "doc_id").filter(~toxicity.learnt_rows()).collect()
    assert sum(r["predicted"] != r["toxic"] for r in got) <= 0.02 * len(got)
    rows = [(f"plain words {marked[i % 5] if i % 2 else 'fine'} here", i % 2) for i in range(400)]
    model = model_of(spark, rows)
    asked = spark.createDataFrame([(w.upper(),) for w in marked], "text string")
    found = asked.select(toxicity.scorer(spark, model)(toxicity.spaced(F.col("text")), F.lit(0)).alias("d")).collect()
    assert all(r["d"] > 1 for r in found)


def test_query_returns_every_document(spark, sf):
    rows = op9_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_messy(spark, messy, clash, no_docs):
    _, labels = labelled(spark, 10)
    assert toxicity.score(messy, labels, toxicity.learnt_rows()).filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert toxicity.score(clash, labels.withColumn("text", F.lit("x")), toxicity.learnt_rows()).count() == messy.count()
    assert {r["score"] for r in toxicity.score(messy, labels.limit(0), toxicity.learnt_rows()).select(F.round("score", 6).alias("score")).collect()} == {0.0}
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (1, 1, 5)], "doc_id long, quality int, toxic int")
    assert toxicity.score(messy, odd, toxicity.learnt_rows()).count() == messy.count()
    assert toxicity.score(no_docs, labels, toxicity.learnt_rows()).count() == 0
