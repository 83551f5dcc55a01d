import collections
import math
import random
import re

from lakelayer.llm import quality
from lakelayer.llm.queries import op5_quality_rules

WORDS = "[^\x20\x09-\x0d]+"


def brute(text):
    text = text or ""
    w = re.findall(WORDS, text)
    runs = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = set()
    for k in range(len(w) - 4):
        if runs[tuple(w[k : k + 5])] > 1:
            covered |= set(range(k, k + 5))
    lines = [x for x in text.split("\n") if re.search(WORDS, x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_query(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_quality_rules(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == brute(docs[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()}
    assert all(r["kept"] for r in rows if r["doc_id"] in good and not r["base_failed"])


def test_packed_bits_collide(spark, messy, monkeypatch):
    """With few hash bits left most windows collide; the counts stay exact."""
    monkeypatch.setattr(quality, "POSITION_BITS", 61)
    rng = random.Random(4)
    more = [(100 + k, " ".join(rng.choice("abc") for _ in range(60)), "en", "a", 0) for k in range(20)]
    df = messy.filter("length(text) < 2000").unionAll(spark.createDataFrame(more, messy.schema))
    for r in quality.judge(df).collect():
        assert tuple(r[c] for c in COLUMNS) == brute(r["text"])


def test_fences_follow_their_group(spark):
    """A symbol share that is usual in one source is an outlier in another."""
    plain, table = "one two three four five six seven eight nine ten eleven", "one | two | three | four | five | six | seven"
    rows = [(i, f"{plain} {i}", "en", "prose", 1) for i in range(60)] + [(100 + i, f"{table} | {i}", "en", "tables", 1) for i in range(60)]
    rows += [(1000, f"{table} | x", "en", "prose", 1)]
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert [k for k, v in kept.items() if not v] == [1000]


def test_each_measure_rejects_below_the_base_cut(spark):
    """One planted outlier per measure and side, among ordinary documents."""
    rng = random.Random(9)

    def words(n, least=3, most=7):
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(least, most))) for _ in range(n)]

    usual = [" ".join(words(12)) + "\n" + " ".join(words(28)) for _ in range(80)]
    few = words(5)
    short = [few[k] for k in (0, 1, 2, 3, 4, 0, 2, 4, 1, 3, 0, 3, 1, 4, 2)]  # no five lines twice
    again = " ".join(words(5))
    planted = {
        "long words": " ".join(words(40, 10, 10)),
        "single letters": " ".join(words(40, 1, 1)),
        "symbols": " ".join(w + ("*" if k % 5 == 0 else "") for k, w in enumerate(words(40))),
        "lines": "\n".join(short + [" ".join(words(8))]),
        "words again": " ".join([again, *words(22), again, *words(20)]),
    }
    rows = [(f"usual {k}", v, "en", "a") for k, v in enumerate(usual)] + [(k, v, "en", "a") for k, v in planted.items()]
    got = quality.judge(spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")).collect()
    assert not any(r["base_failed"] for r in got)
    assert {r["doc_id"] for r in got if not r["kept"]} == set(planted)


def test_sketch_quantiles_are_near_and_equal_on_every_run(spark):
    """Fences from exact quartiles differ by the sketch's accuracy only, and ``kept``
    only within it; another partitioning gives the same fences."""
    rng = random.Random(11)
    rows = []
    for k in range(3000):
        lang, source = rng.choice(["en", "de"]), rng.choice(["a", "b", None])
        w = ["x" * max(1, int(rng.lognormvariate(1.5, 0.7))) + rng.choice(["", "", "", "#", "*|"]) for _ in range(rng.randint(11, 60))]
        rows.append((k, " ".join(w), lang, source))
    rows += [(9000 + k, "few words of a small group that has no thresholds of its own", "en", "small") for k in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    a, b = ({r["doc_id"]: r.asDict() for r in quality.judge(df.repartition(n)).collect()} for n in (3, 7))
    assert a == b
    groups = collections.defaultdict(list)
    for r in a.values():
        groups[r["lang"], r["source"]].append((r["word_chars"] / r["n_words"], r["n_symbols"] / r["n_words"]))
    near = 0
    for r in a.values():
        own = groups[r["lang"], r["source"]]
        if len(own) < 30:
            own = [v for (lang, _), g in groups.items() if lang == r["lang"] for v in g]
        held = True
        for m, (name, floor) in enumerate((("word_length", 0.5), ("symbol_share", 0.02))):
            v = sorted(x[m] for x in own)
            q1, q3 = (v[max(0, math.ceil(len(v) * p) - 1)] for p in (0.25, 0.75))
            fence = q3 + 6 * max(q3 - q1, floor)
            assert abs(r[f"fence_{name}"] - fence) <= 14 * 0.0051 * q3 + 1e-9
            mine = (r["word_chars"], r["n_symbols"])[m] / r["n_words"]
            near += abs(mine - fence) <= 14 * 0.0051 * q3
            held = held and mine <= r[f"fence_{name}"]
        assert not (r["kept"] and not held)
    assert near < 300


def test_messy(messy, clash, no_docs):
    for r in quality.judge(messy).collect():
        assert tuple(r[c] for c in COLUMNS) == brute(r["text"])
    assert quality.judge(clash).count() == messy.count()
    assert quality.judge(no_docs).count() == 0
