"""Toxicity: class-conditional Kneser-Ney models over words and word pairs.

An expression is a word, or a word after another.  It is counted once per
text and class.  Pooled continuation counts (different words in front) give
the shared backoff; each class interpolates its discounted counts with it, a pair
with the class's own model of its word:

    P_y(w)   = (max(n_y(w) - D, 0) + D * kinds_y * P_shared(w)) / N_y
    P_y(w|u) = (max(n_y(uw) - D, 0) + D * kinds_y(u) * P_y(w)) / N_y(u)

A pair that isn't told apart counts as its word alone: the contexts' backoff
weights, which differ with the sizes of the classes' samples, are taken as equal
(and so P_y(w) where the class has not seen u).  An expression whose classes
differ no more than chance or than ``LEAST_FACTOR`` is left to the shared backoff:
both classes give it the same probability.  Chance: the gain in log-likelihood
of its own class shares over those of all must exceed the logarithm of the
number of expressions by -log ``CHANCE``.  How many texts that takes follows from
the shares and the vocabulary; there is no least number of texts.  A text's
evidence is the toxic minus the ordinary log-likelihood, divided by its number
of words.

A logistic curve makes it a score.  It is fitted on all labelled texts of the
sample; a text's own count is first taken out of the expressions that it holds,
as if the model had not seen it.  Two pseudo-texts of evidence +-``PRIOR`` stand
for the belief that more evidence is more toxic, where labels are too few to
show it.

The models are fitted on a documented, bounded sample of labelled rows (about
``MAX_CHARS`` characters a class, by a hash of the text), which bounds the
tables that are broadcast; scoring reads every text whole.

Defined results: NULL or empty text has no evidence (0); rows are scored one by
one; of several labels of one id the largest counts; without labels of both
classes every score is the share of toxic labels (0 without labels); an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import materialize

MAX_CHARS = 32_000_000
DISCOUNT = 0.75
CHANCE = 0.001  # expected number of expressions taken for different by chance
LEAST_FACTOR = 3.0
PRIOR = 0.05
NO_WORD = r"[^\p{L}\p{M}\p{N}]+"  # words are letters, their marks and digits


def spaced(text: Column) -> Column:
    """The words of a text with one space between; counting and scoring both read this."""
    return F.trim(F.regexp_replace(F.lower(text), NO_WORD, " "))


def drawn(th: Column, rate: Column) -> Column:
    """Whether a text is in the sample, by its hash."""
    return F.pmod(F.xxhash64(th, F.lit(1)), F.lit(1 << 30)) < F.round(rate * float(1 << 30))


def sample_of(learnt: DataFrame, known: DataFrame) -> DataFrame:
    """(__text, toxic): different labelled texts, about MAX_CHARS characters a class (all
    where there are fewer), none over a sixteenth of that.  Only hashes and lengths
    are joined with the labels; of the texts, only those in the sample move."""
    th = F.xxhash64("__text")
    slim = learnt.select("__id", th.alias("__h"), F.length("__text").alias("__n")).join(known, "__id")
    # Copies count once; their labels, should they differ, as toxic.
    slim = slim.groupBy("__h").agg(F.max("toxic").alias("toxic"), F.max("__n").alias("__n"))
    short = materialize(slim).filter(F.col("__n") <= MAX_CHARS // 16)
    totals = short.groupBy("toxic").agg(F.sum(F.col("__n") + 64).alias("n")).collect()  # two rows
    rate, most = F.lit(0.0), 0.0
    for r in totals:
        part = min(1.0, MAX_CHARS / r["n"])
        rate, most = F.when(F.col("toxic") == r["toxic"], part).otherwise(rate), max(most, part)
    picked = short.filter(drawn(F.col("__h"), rate)).select("__h", "toxic")
    texts = learnt.select("__text", th.alias("__h")).filter(drawn(F.col("__h"), F.lit(most)))
    texts = texts.groupBy("__h").agg(F.any_value("__text").alias("__text"))  # copies meet on the map side
    return texts.join(picked, "__h").drop("__h")


def over(n: Column) -> Column:
    """A discounted count."""
    return F.greatest(n - DISCOUNT, F.lit(0.0))


def gain(n0: Column, n1: Column, t0: Column, t1: Column) -> Column:
    """Log-likelihood of an expression's own class shares over those of all expressions."""
    n, t = n0 + n1, t0 + t1

    def part(k: Column, all_: Column) -> Column:
        return F.when(k > 0, k * F.log(k * t / (n * all_))).otherwise(0.0)

    return part(n0, t0) + part(n1, t1)


def counts(sample: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts of each class (n0, n1) that hold a word (w) or a pair (u, w; u is empty at
    the start), in one pass."""
    w = F.array_remove(F.split(spaced(F.col("__text")), " "), "")
    rows = sample.select("toxic", w.alias("w")).filter(F.size("w") > 0)
    # As strings: distinct structs would be compared pair by pair.
    pair = F.transform("w", lambda x, i: F.concat(F.when(i > 0, F.get("w", i - 1)).otherwise(""), F.lit(" "), x))
    pairs = rows.select("toxic", F.explode(F.array_distinct(pair)).alias("p"))
    pairs = pairs.select("toxic", F.substring_index("p", " ", 1).alias("u"), F.substring_index("p", " ", -1).alias("w"))
    each = [F.sum((F.col("toxic") == y).cast("long")).alias(f"n{y}") for y in (0, 1)]
    single = rows.select("toxic", F.explode(F.array_distinct("w")).alias("w")).groupBy("w").agg(*each)
    return materialize(single), materialize(pairs.groupBy("u", "w").agg(*each))


#: What is taken out of the counts of (ordinary, toxic) texts: nothing, an ordinary
#: text, a toxic one.
WITHOUT = ((0, 0), (1, 0), (0, 1))


def expressions(single: DataFrame, pairs: DataFrame) -> tuple[dict, dict]:
    """Log ratios per word, and per (word in front, word), where it isn't left to the
    shared backoff: of all texts, without an ordinary text that holds it, and
    without a toxic one (0 where it is then left to the backoff)."""
    single = single.join(pairs.groupBy("w").agg(F.count("*").alias("__cont")), "w")
    kinds = [F.count(F.when(F.col(f"n{y}") > 0, 1)).alias(f"k{y}") for y in (0, 1)]
    sums = [F.sum(f"n{y}").alias(f"t{y}") for y in (0, 1)]
    whole = single.agg(F.sum("__cont").alias("c"), F.count("*").alias("m"), *kinds, *sums).first()
    if not whole["c"] or not whole["t0"] or not whole["t1"]:
        return {}, {}

    # The pooled continuation counts add up to the number of different pairs.
    least_word, least_pair = (math.log(m / CHANCE) for m in (whole["m"], whole["c"]))

    def ratio(p0: Column, p1: Column, far: Column) -> Column:
        r = F.log(p1 / p0)
        return F.when(far & (F.abs(r) >= float(np.log(LEAST_FACTOR))), r).otherwise(0.0)

    shared, by_word = F.col("__cont") / float(whole["c"]), {}
    for v, out in enumerate(WITHOUT):
        n = [F.greatest(F.col(f"n{y}") - out[y], F.lit(0)) for y in (0, 1)]
        by_word |= {f"q{y}{v}": (over(n[y]) + DISCOUNT * whole[f"k{y}"] * shared) / float(whole[f"t{y}"]) for y in (0, 1)}
        by_word[f"far{v}"] = gain(n[0], n[1], F.lit(whole["t0"]), F.lit(whole["t1"])) >= least_word
    single = single.withColumns(by_word)
    words = single.select("w", *[ratio(F.col(f"q0{v}"), F.col(f"q1{v}"), F.col(f"far{v}")).alias(f"r{v}") for v in range(3)]).filter("r0 <> 0")

    contexts = pairs.groupBy("u").agg(*kinds, *sums)
    pairs = pairs.join(contexts, "u").filter(gain(F.col("n0"), F.col("n1"), F.col("t0"), F.col("t1")) >= least_pair)
    pairs = pairs.join(single.select("w", *[c for c in by_word if c[0] == "q"]), "w")
    by_pair = []
    for v, out in enumerate(WITHOUT):
        n = [F.greatest(F.col(f"n{y}") - out[y], F.lit(0)) for y in (0, 1)]
        p = []
        for y in (0, 1):
            t, shorter = F.col(f"t{y}") - out[y], F.col(f"q{y}{v}")
            p.append(F.when(t > 0, (over(n[y]) + DISCOUNT * F.col(f"k{y}") * shorter) / t).otherwise(shorter))
        by_pair.append(ratio(*p, gain(*n, *[F.col(f"t{y}") - out[y] for y in (0, 1)]) >= least_pair).alias(f"r{v}"))
    pairs = pairs.select("u", "w", *by_pair).filter("r0 <> 0")
    # Expressions of the bounded sample, each in several of its texts.
    return {r["w"]: (r["r0"], r["r1"], r["r2"]) for r in words.collect()}, {(r["u"], r["w"]): (r["r0"], r["r1"], r["r2"]) for r in pairs.collect()}


NOTHING = (0.0, 0.0, 0.0)


def evidence(text: str, words: dict, pairs: dict, without: int = 0) -> float:
    """Mean log ratio per word of a spaced text; a pair's where it has one, else the
    word's.  ``without``: a place in WITHOUT."""
    own = text.split()
    total, before = 0.0, ""
    for w in own:
        total += pairs.get((before, w), NOTHING)[without] or words.get(w, NOTHING)[without]
        before = w
    return total / max(len(own), 1)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a ridge-smoothed logistic curve, by Newton steps on
    the scaled evidence."""
    scale = float(np.sqrt(np.average((x - np.average(x, weights=weight)) ** 2, weights=weight))) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), a.T @ (weight * (y - p)) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def scorer(spark, model):
    """Pandas UDF: the evidence of a spaced text, with a place in WITHOUT."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        words, pairs = shared.value
        for texts, without in batches:
            yield pd.Series([evidence(t, words, pairs, v) for t, v in zip(texts, without, strict=True)], dtype=float)

    return run


def fit(learnt: DataFrame, known: DataFrame):
    """Log ratios and the curve (slope, intercept) from texts (__id, __text) and
    labels (__id, toxic)."""
    spark = learnt.sparkSession
    sample = materialize(sample_of(learnt, known).repartition(2 * spark.sparkContext.defaultParallelism))
    model = expressions(*counts(sample))
    unseen = sample.select("toxic", scorer(spark, model)(spaced(F.col("__text")), F.col("toxic") + 1).alias("__d"))
    seen = unseen.groupBy("toxic", F.round("__d", 6).alias("__d")).agg(F.count("*").alias("n")).toPandas()  # of the bounded sample
    seen = seen.sort_values(["__d", "toxic"])  # sums in one order, so reruns agree
    n, toxic = float(seen["n"].sum()), float((seen["n"] * seen["toxic"]).sum())
    if not 0 < toxic < n:
        share = toxic / n if n else 0.0
        return model, (0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    x, y, w = (np.append(seen[c].to_numpy(float), more) for c, more in (("__d", (PRIOR, -PRIOR)), ("toxic", (1.0, 0.0)), ("n", (1.0, 1.0))))
    return model, logistic(x, y, w)


def score(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", ident: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``docs`` plus score and predicted; labels are learnt from the rows of
    ``docs`` for which ``learn`` holds.  Columns of these names are replaced."""
    docs = docs.drop("score", "predicted")
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(ident).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    learnt = docs.filter(learn).select(F.col(ident).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    model, (slope, intercept) = fit(learnt, known)
    df = docs.withColumn("__d", scorer(docs.sparkSession, model)(spaced(F.coalesce(F.col(text), F.lit(""))), F.lit(0)))
    value = 1 / (1 + F.exp(-(F.col("__d") * slope + intercept)))
    return df.withColumn("score", value).withColumn("predicted", (F.col("score") >= 0.5).cast("int")).drop("__d")


def learnt_rows(ident: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text is not divisible by 5; NULL ids are not learnt from."""
    return F.coalesce(F.crc32(F.col(ident).cast("string").cast("binary")) % 5 != 0, F.lit(False))
