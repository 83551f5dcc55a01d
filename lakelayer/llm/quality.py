"""Quality rules with adaptive thresholds.

Every text is measured once and the measures are written without it.  Per
(language, source) a quantile sketch of each measure is aggregated: counts per
logarithmic bucket, whose quantiles lie within ``ACCURACY`` of the value, depend
on the values alone, and merge by adding counts.  The sketches of a language
are merged from those of its groups and serve groups too small for thresholds
of their own.  A document's measures are joined with the thresholds of its
group; it is
rejected above the upper fence ``q3 + reach * max(q3 - q1, floor)``, and, where
low values are bad too, below the lower fence, which is as many times below q1
as ``q3 + reach * max(q3 - q1, low floor)`` is above q3.

Defined results: NULL or empty text has no words and fails the base check;
NULL language and NULL source are groups of their own; rows are judged one by
one; an empty table gives an empty result.  Built-in functions only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import SPACE, SPACE_RE, key, materialize

SYMBOLS = "#*$%&|<>"
#: Measure -> least spread of its fence.  Six times that is less than a share can
#: reach, and less than the base cut of the repeated words.
FENCES = {"word_length": 0.5, "symbol_share": 0.02, "dup_line_share": 0.08, "repeat_share": 0.03}
#: Measure of which low values are bad too -> least spread of its lower fence.
LOW_FENCES = {"word_length": 1.0}
ACCURACY = 0.005  # of a sketch's quantiles, as a share of the value
GROWTH = (1 + ACCURACY) / (1 - ACCURACY)
ZERO = -(1 << 30)  # the bucket of 0
POSITION_BITS = 28  # a text has fewer than 2 ** 28 words: a string holds 2 ** 31 bytes at most


def word_measures(df: DataFrame, text: str) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, __n_lines (long)."""
    df = df.withColumn("__t", F.coalesce(F.col(text), F.lit("")))
    spaceless = F.translate("__t", SPACE, "")
    lines = F.filter(F.split("__t", "\n"), lambda x: F.translate(x, SPACE, "") != "")
    df = df.withColumns(
        {
            "__w": F.array_remove(F.split("__t", SPACE_RE), ""),
            "__l": lines,
            "word_chars": F.length(spaceless).cast("long"),
            "n_symbols": (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long"),
        }
    )
    df = df.withColumns({"n_words": F.size("__w").cast("long"), "__n_lines": F.size("__l").cast("long"), "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long")})
    return repeated_words(df, "__w", 5).drop("__t", "__l", "__w")


def repeated_words(df: DataFrame, words: str, n: int) -> DataFrame:
    """n_repeat_words: words in windows of ``n`` that occur twice or more.

    The 64-bit hash of each window, its upper bits packed with the window's
    position, is sorted as one array of longs; equal neighbours (checked on all
    64 bits) are repeats.  Of windows whose packed bits agree with a neighbour's
    but not the hash, equal ones may stand apart: these few are compared with
    all windows that have a neighbour of the same packed bits."""
    mask = (1 << POSITION_BITS) - 1
    w = F.col(words)

    def window(_, i):
        return F.xxhash64(*[F.get(w, i + k) for k in range(n)])

    starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(0)))
    df = df.withColumn("__h", F.transform(starts, window))
    has = F.size(F.array_distinct("__h")) < F.size("__h")
    packed = F.transform("__h", lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))
    df = df.withColumn("__p", F.when(has, F.sort_array(packed)))
    p, h = F.col("__p"), F.col("__h")

    def position(x: Column) -> Column:
        return x.bitwiseAND(F.lit(mask)).cast("int")

    def same(x: Column, y: Column) -> Column:
        return F.coalesce(F.get(h, position(x)) == F.get(h, position(y)), F.lit(False))

    def alike(x: Column, y: Column) -> Column:
        return F.coalesce(F.shiftright(x, POSITION_BITS) == F.shiftright(y, POSITION_BITS), F.lit(False))

    def state(x: Column, i: Column) -> Column:
        """The position of a window equal to a neighbour; -2 - position where only
        the packed bits agree; else -1."""
        before, behind = F.get(p, i - 1), F.get(p, i + 1)
        return F.when(same(x, before) | same(x, behind), position(x)).when(alike(x, before) | alike(x, behind), -2 - position(x)).otherwise(-1)

    df = df.withColumn("__near", F.transform(p, state))
    near = F.col("__near")
    df = df.withColumn("__odd", F.transform(F.filter(near, lambda v: v < -1), lambda v: -2 - v))
    odd = F.col("__odd")  # a few windows at most
    others = F.transform(F.filter(near, lambda v: v != -1), lambda v: F.when(v < 0, -2 - v).otherwise(v))
    twin = F.filter(odd, lambda c: F.exists(others, lambda d: (d != c) & (F.get(h, d) == F.get(h, c))))
    df = df.withColumn("__q", F.sort_array(F.concat(F.filter(near, lambda v: v >= 0), twin)))
    q = F.col("__q")
    covered = F.aggregate(F.transform(q, lambda x, i: F.least(F.lit(n), F.coalesce(F.get(q, i + 1) - x, F.lit(n)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__h", "__p", "__near", "__odd", "__q")


def measures(least: Mapping[str, float]) -> dict[str, Column]:
    """Shares that the fences hold; a document without words has none."""
    n = F.when(F.col("n_words") > 0, F.col("n_words").cast("double"))
    shares = {
        "word_length": F.col("word_chars") / n,
        "symbol_share": F.col("n_symbols") / n,
        "dup_line_share": F.col("n_dup_lines") / F.when(n > 0, F.col("__n_lines").cast("double")),
        "repeat_share": F.col("n_repeat_words") / n,
    }
    return {m: shares[m] for m in least}


def bucket(value: Column) -> Column:
    """The sketch's bucket of a value of 0 or more: i where g^(i-1) < value <= g^i."""
    return F.when(value > 0, F.ceil(F.log(value) / math.log(GROWTH)).cast("int")).otherwise(ZERO)


def bucket_value(i: Column) -> Column:
    """The value that stands for a bucket, within ACCURACY of all that it holds."""
    return F.when(i == ZERO, 0.0).otherwise(2.0 * F.pow(F.lit(GROWTH), i) / (GROWTH + 1.0))


def quantile(sketch: Column, n: Column, p: float) -> Column:
    """The value at a share of a sketch, an array of (bucket, n) in the order of buckets."""
    rank = F.greatest(F.ceil(n * p), F.lit(1))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("int").alias("at"))

    def step(a: Column, x: Column) -> Column:
        below = a["n"] + x["n"]
        return F.struct(below.alias("n"), F.when(a["at"].isNull() & (below >= rank), x["bucket"]).otherwise(a["at"]).alias("at"))

    return bucket_value(F.aggregate(sketch, start, step)["at"])


def thresholds(df: DataFrame, fences: Mapping[str, float], low_fences: Mapping[str, float], reach: float, least_rows: int) -> DataFrame:
    """__lang, __source, a fence per measure and its lower fence, if any, from
    sketches of all rows."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col(f"__{m}").alias("v")) for m in fences])).alias("x")
    rows = df.filter("n_words > 0").select("__lang", "__source", each).select("__lang", "__source", "x.m", bucket(F.col("x.v")).alias("bucket"))
    counts = materialize(rows.groupBy("__lang", "__source", "m", "bucket").agg(F.count("*").alias("n")))
    merged = counts.groupBy("__lang", "m", "bucket").agg(F.sum("n").alias("n"))

    def quartiles(sketches: DataFrame, *keys: str) -> DataFrame:
        ordered = F.sort_array(F.collect_list(F.struct("bucket", "n")))  # as many as buckets
        whole = sketches.groupBy(*keys, "m").agg(F.sum("n").alias("n"), ordered.alias("s"))
        return whole.select(*keys, "m", "n", *[quantile(F.col("s"), F.col("n"), p).alias(q) for q, p in (("q1", 0.25), ("q3", 0.75))])

    own, whole = quartiles(counts, "__lang", "__source"), quartiles(merged, "__lang")
    both = own.join(whole.select("__lang", "m", F.col("q1").alias("all1"), F.col("q3").alias("all3")), ["__lang", "m"])
    few = F.col("n") < least_rows
    both = both.withColumns({"q1": F.when(few, F.col("all1")).otherwise(F.col("q1")), "q3": F.when(few, F.col("all3")).otherwise(F.col("q3"))})

    def above(floor: float) -> Column:
        return F.col("q3") + reach * F.greatest(F.col("q3") - F.col("q1"), F.lit(floor))

    high = [F.max(F.when(F.col("m") == m, above(f))).alias(f"__fence_{m}") for m, f in fences.items()]
    low = [F.max(F.when(F.col("m") == m, F.col("q1") * F.col("q3") / above(f))).alias(f"__fence_low_{m}") for m, f in low_fences.items()]
    return both.groupBy("__lang", "__source").agg(*high, *low)


def judge(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    fences: Mapping[str, float] = FENCES,
    reach: float = 6.0,
    least_rows: int = 30,
    least_words: int = 10,
    repeat_percent: int = 20,
    low_fences: Mapping[str, float] = LOW_FENCES,
    with_text: bool = True,
) -> DataFrame:
    """``docs`` (without the text column unless ``with_text``, which is then written
    along) plus the counts, base_failed, kept, a fence_<measure> each and a
    fence_low_<measure> where low values are bad.  Columns of these names in
    ``docs`` are replaced."""
    low_fences = {m: f for m, f in low_fences.items() if m in fences}
    bounds = [f"fence_{m}" for m in fences] + [f"fence_low_{m}" for m in low_fences]
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *bounds]
    df = word_measures(docs.drop(*own), text)
    df = df.withColumns({"__lang": key(F.col(lang)), "__source": key(F.col(source)), **{f"__{m}": c for m, c in measures(fences).items()}})
    df = materialize(df if with_text else df.drop(text))
    fenced = thresholds(df, fences, low_fences, reach, least_rows)
    df = df.join(fenced, ["__lang", "__source"], "left")
    base = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    within = F.lit(True)
    for m in fences:
        within = within & F.coalesce(F.col(f"__{m}") <= F.col(f"__fence_{m}"), F.lit(True))
    for m in low_fences:
        within = within & F.coalesce(F.col(f"__{m}") >= F.col(f"__fence_low_{m}"), F.lit(True))
    df = df.withColumns({"base_failed": base, **{b: F.col(f"__{b}") for b in bounds}})
    df = df.withColumn("kept", ~F.col("base_failed") & within)
    return df.drop("__lang", "__source", "__n_lines", *[f"__{m}" for m in fences], *[f"__{b}" for b in bounds])
