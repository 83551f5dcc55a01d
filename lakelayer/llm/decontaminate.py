"""Benchmark decontamination through a distributed positional inverted index.

A window is ``window`` consecutive words of a test item (an item of fewer words
is one window).  The corpus frequency of all test terms is counted first; each
window gets as anchors its rarest and its second rarest term, and windows with
a term that the corpus lacks are out.  The index stores the postings (document,
position) of the anchor terms in the shared folder.  Posting lists are
intersected after their offsets are taken off: of an alignment (document,
item, difference of positions) are left those where both anchors of some
window meet; the document's words then decide on the exact phrase.  Proximity
matches are windows whose two anchors stand up to ``slop`` words further
apart or closer than in the item, in either order.

Built-in functions only.  Test tables are joined by equality, without a
broadcast hint; only test terms' positions leave the scan.

Defined results: NULL or empty text has no words and no hits; rows with the
same id and text have the same result; NULL item ids are listed as the empty
string; repeated test rows count once; empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import ascii_lower, materialize

WORD_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 10


def terms(text: Column) -> Column:
    """Runs of a-z, 0-9 and characters beyond ASCII, A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def items_of(benchmark: DataFrame, ident: str, text: str) -> DataFrame:
    """(item, words, body): different test items that have words."""
    items = benchmark.select(F.coalesce(F.col(ident).cast("string"), F.lit("")).alias("item"), terms(F.col(text)).alias("words"))
    return items.filter(F.size("words") > 0).distinct().withColumn("body", F.xxhash64("words"))


def windows_of(items: DataFrame, frequency: DataFrame, window: int) -> DataFrame:
    """(item, body, start, a1, t1, a2, t2): the windows all of whose terms occur,
    with the positions in the item and the terms of the rarest and the second
    rarest (a window of one word is its own second)."""
    start = F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0))))
    cut = items.withColumn("start", start).withColumn("cut", F.slice("words", F.col("start") + 1, F.lit(window)))
    long = cut.select("item", "body", "start", F.size("cut").alias("n"), F.posexplode("cut").alias("p", "term"))
    rare = F.sort_array(F.collect_list(F.struct("df", "p", "term")))  # as long as a window
    ranked = long.join(frequency, "term").groupBy("item", "body", "start", "n").agg(rare.alias("r")).filter(F.size("r") == F.col("n"))
    ranked = ranked.withColumns({"x": F.get("r", F.lit(0)), "y": F.get("r", F.when(F.col("n") > 1, 1).otherwise(0))})
    return ranked.select(
        "item", "body", "start", (F.col("start") + F.col("x.p")).alias("a1"), F.col("x.term").alias("t1"), (F.col("start") + F.col("y.p")).alias("a2"), F.col("y.term").alias("t2")
    )


def postings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Positional index of the ``wanted`` terms: (term, k1, k2, pos)."""
    return docs.select("k1", "k2", F.posexplode("w").alias("pos", "term")).join(wanted, "term")


def search(docs: DataFrame, benchmark: DataFrame, text: str, ident: str, item: str, item_text: str, window: int, slop: int) -> DataFrame:
    """Per document (k1, k2) with a match: spans (start, length) of the windows
    found, the items found exactly and the number found in proximity."""
    words = docs.select("k1", "k2", terms(F.col(text)).alias("w"))
    items = materialize(items_of(benchmark, item, item_text))
    test_terms = materialize(items.select(F.explode("words").alias("term")).distinct())
    frequency = materialize(postings(words, test_terms).groupBy("term").agg(F.count("*").alias("df")))
    windows = materialize(windows_of(items, frequency, window))
    two = [F.struct(F.col(f"t{a}").alias("term"), F.col(f"a{a}").alias("at"), F.col(f"a{b}").alias("mate")) for a, b in ((1, 2), (2, 1))]
    anchors = windows.select("item", "body", F.explode(F.array(*two)).alias("a")).select("item", "body", "a.*")
    anchors = materialize(anchors.groupBy("item", "body", "term", "at").agg(F.collect_set("mate").alias("mates")))  # mates: of one item
    index = materialize(postings(words, anchors.select("term").distinct()))
    found = index.join(anchors, "term").select("k1", "k2", "item", "body", (F.col("pos") - F.col("at")).alias("delta"), "at", "mates")
    found = materialize(found)

    # Intersection: alignments that hold both anchors of a window.
    held = [F.collect_set("at").alias("at"), F.array_distinct(F.flatten(F.collect_set("mates"))).alias("mates")]  # positions of one item
    met = found.groupBy("k1", "k2", "item", "body", "delta").agg(*held)
    met = materialize(met.filter(F.arrays_overlap("at", "mates")).select("k1", "k2", "item", "body", "delta"))

    # Exact phrase: the document's words against the item's.
    texts = words.join(met.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    full = met.join(items, ["item", "body"]).join(texts, ["k1", "k2"])
    n = F.least(F.size("words"), F.lit(window))
    equal = F.transform("words", lambda x, j: F.coalesce(F.get("w", F.col("delta") + j) == x, F.lit(False)))
    full = full.withColumn("equal", equal).withColumn("n", n)
    starts = F.filter(F.sequence(F.lit(0), F.size("words") - F.col("n")), lambda s: F.forall(F.slice("equal", s + 1, F.col("n")), lambda e: e))
    spans = full.select("k1", "k2", "item", F.transform(starts, lambda s: F.struct((F.col("delta") + s).alias("start"), F.col("n").alias("n"))).alias("spans"))
    exact = spans.filter(F.size("spans") > 0).groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.collect_set("item").alias("items"))

    # Proximity: both anchors of a window, up to slop words off their offsets.
    pairs = windows.select("item", "body", F.col("a1").alias("at"), "a2").distinct()
    first = found.join(pairs, ["item", "body", "at"])
    first = first.select("k1", "k2", "item", "body", F.col("a2").alias("at"), F.explode(F.sequence(F.col("delta") - slop, F.col("delta") + slop)).alias("delta"))
    near = first.join(found, ["k1", "k2", "item", "body", "at", "delta"]).groupBy("k1", "k2").agg(F.count_distinct("item").alias("n_near"))
    return exact.join(near, ["k1", "k2"], "full")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    ident: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    slop: int = 2,
) -> DataFrame:
    """``docs`` plus n_words, n_hit (words inside a window found), n_items, item_ids
    (sorted as strings, comma-joined), n_near (items found in proximity, exact
    ones included) and contaminated.  Columns of these names are replaced."""
    docs = docs.drop("n_words", "n_hit", "n_items", "item_ids", "n_near", "contaminated")
    keyed = docs.withColumns({"k1": F.coalesce(F.col(ident).cast("string"), F.lit("~")), "k2": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    hits = search(keyed.select("k1", "k2", F.col(text).alias("__t")), benchmark, "__t", ident, item, item_text, window, slop)
    # Words covered by the spans, in the order of their starts.
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).alias("n"))

    def cover(a: Column, s: Column) -> Column:
        end = s["start"] + s["n"]
        return F.struct(F.greatest(a["reach"], end).alias("reach"), (a["n"] + F.greatest(end - F.greatest(a["reach"], s["start"]), F.lit(0))).alias("n"))

    covered = F.aggregate(F.sort_array("spans"), start, cover)["n"]
    ids = F.array_sort("items")
    hits = hits.select("k1", "k2", covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_join(ids, ",").alias("item_ids"), "n_near")
    out = keyed.withColumn("n_words", F.size(terms(F.col(text))).cast("long")).join(hits, ["k1", "k2"], "left").drop("k1", "k2")
    out = out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_hit", "n_items", "n_near")})
    return out.withColumns({"item_ids": F.coalesce("item_ids", F.lit("")), "contaminated": F.col("n_hit") > 0})
