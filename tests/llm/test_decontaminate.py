import collections
import hashlib
import re

from lakelayer.llm import decontaminate
from lakelayer.llm.queries import op7_decontamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))


def brute(docs, items):
    windows = collections.defaultdict(lambda: collections.defaultdict(set))
    for i, t in items:
        w = words(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows[n][tuple(w[s : s + n])].add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n, held in windows.items():
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in held:
                    hit |= set(range(s, s + n))
                    found |= held[tuple(w[s : s + n])]
        out.append((i, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit)))
    return out


def rows_of(df):
    return [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["item_ids"], r["contaminated"]) for r in df.collect()]


def test_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = {w[0]: w for w in brute(docs, items)}
    assert any(w[-1] for w in want.values())
    for r in op7_decontamination(spark, sf).collect():
        w = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (*w[1:4], w[5])
        assert r["items_sha256"] == hashlib.sha256(w[4].encode()).hexdigest()


def test_messy(spark, messy, clash, no_docs):
    items = [
        (1, "THE cat, sat on the mat and looked at the moon -- and more"),
        (10, "cat sat"),
        (2, "sat cat"),
        (2, "a"),
        (None, "no id at all"),
        (3, None),
        (4, "..."),
        (10, "cat sat"),
        (5, "a a a"),
        (6, "word0 again word1 again word2 again word3 again word4 again word5"),
    ]
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, n_hit string")
    docs = [(r["doc_id"], r["text"]) for r in messy.collect()]
    want = sorted(brute(docs, items), key=str)
    assert sorted(rows_of(decontaminate.decontaminate(messy, bench)), key=str) == want
    assert sorted(rows_of(decontaminate.decontaminate(clash, bench)), key=str) == want
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    assert decontaminate.decontaminate(messy, bench.limit(0)).filter("contaminated").count() == 0


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = [(1, item), (2, item.replace("beta", "beta so")), (3, "alpha " + "filler " * 20 + "beta"), (4, "beta alpha")]
    got = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    rows = {r["doc_id"]: (r["contaminated"], r["n_near"]) for r in got.collect()}
    assert rows[1] == (True, 1) and rows[2] == (False, 1) and not rows[3][0] and not rows[4][0]
