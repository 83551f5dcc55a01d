"""Ranked lexical search: hybrid term-at-a-time and document-at-a-time.

The corpus is indexed in blocks of documents, each within one task: a block
holds the posting lists (document, occurrences) of all query terms, and the
lengths of its documents.  The blocks are written to the shared folder; the
corpus statistics (documents, terms, documents per term) are sums over them.

A block answers a query in two steps.  The short lists are read term at a time
into summed accumulators.  These then stand beside the long lists as one more
iterator with a bound of its own, and documents are visited in order, a window
of ``WINDOW`` at a time: a window is skipped if the accumulators' largest sum
in it plus the long lists' largest contributions in it are below the score to
beat.  That score is the k-th best so far, carried from block to block in
a task; at the start, the k-th largest accumulator.  Skipping is strict, so
documents of equal score are all seen and the smaller id wins.

Per task and query at most ``k`` documents go on to the final ranking, which is
done in two levels.  The queries are taken in blocks of ``QUERY_BYTES``: one
block's terms and weights are broadcast.  No posting list is ever gathered
beyond its block, so a term that all documents hold is spread over all tasks.

Score: a term's weight is floor(1000 ln((2N+2)/(2df+1))); a document's length
norm m is 100-25 + (25 n N) div L; a term adds its weight times
(10^9 tf) div (1000 tf + 12 m), as often as the query repeats it.

Defined results: NULL text has no terms; NULL ids count as ids and come first
among equal scores; repeated rows rank separately; a query row is a distinct
(item, text); items without a hit have no rows; empty tables give an empty
result.  An id of -2^63 is read as NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import materialize

BLOCK_TERMS = 3_000_000  # occurrences of query terms in a block
BLOCK_DOCS = 60_000
QUERY_BYTES = 4_000_000
WINDOW = 64
SALTS = 64
LEAST = -(2**63)
#: Bytes of a term: digits, letters (lower-cased) and all beyond ASCII; others part terms.
TERM_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
BLOCK = "n_docs long, n_terms long, terms array<int>, df array<int>, payload binary"


def terms_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(TERM_BYTES).split() if raw else []


class Builder:
    """Collects documents of a block."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.get = vocabulary.get
        self.n_docs = self.n_terms = 0
        self.ids: list[int] = []
        self.lengths: list[int] = []
        self.held: list[int] = []
        self.found: list[int] = []

    def add(self, ident: int | None, raw: bytes | None) -> None:
        own = terms_of(raw)
        if own:
            self.n_docs += 1
            self.n_terms += len(own)
            get, before = self.get, len(self.found)
            self.found += [t for t in map(get, own) if t is not None]
            if len(self.found) > before:
                self.ids.append(LEAST if ident is None else ident)
                self.lengths.append(len(own))
                self.held.append(len(self.found) - before)

    def full(self) -> bool:
        return len(self.found) >= BLOCK_TERMS or len(self.ids) >= BLOCK_DOCS

    def row(self) -> pa.RecordBatch:
        import zstandard

        d = max(1, len(self.ids))
        keys = np.array(self.found, dtype=np.int64) * d + np.repeat(np.arange(len(self.ids)), self.held)
        keys, tf = np.unique(keys, return_counts=True)
        terms, df = np.unique(keys // d, return_counts=True)
        arrays = [np.array(self.ids, "<i8"), np.array(self.lengths, "<i8"), terms.astype("<i4"), df.astype("<i4"), (keys % d).astype("<i4"), tf.astype("<i4")]
        raw = np.array([len(self.ids), len(terms), len(keys)], "<i8").tobytes() + b"".join(a.tobytes() for a in arrays)
        row = {"n_docs": self.n_docs, "n_terms": self.n_terms, "terms": terms.tolist(), "df": df.tolist(), "payload": zstandard.ZstdCompressor(level=3).compress(raw)}
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("terms", pa.list_(pa.int32())), ("df", pa.list_(pa.int32())), ("payload", pa.binary())]))


class Block:
    """A block's posting lists with the contribution of each posting to a weight of 1."""

    def __init__(self, payload: bytes, n_docs: int, n_terms: int, vocabulary: int):
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(payload)
        d, t, p = np.frombuffer(raw, "<i8", 3)
        at, parts = 24, []
        for kind, n in (("<i8", d), ("<i8", d), ("<i4", t), ("<i4", t), ("<i4", p), ("<i4", p)):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += parts[-1].nbytes
        self.ids, lengths, terms, df, self.docs, tf = parts
        m = 100 - 25 + (25 * lengths * n_docs) // n_terms
        self.gain = (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 12 * m[self.docs])
        self.starts = np.concatenate([[0], np.cumsum(df)])
        self.most = np.maximum.reduceat(self.gain, self.starts[:-1]) if len(terms) else np.zeros(0, np.int64)
        self.slot = np.full(vocabulary, -1, np.int64)
        self.slot[terms] = np.arange(len(terms))
        self.sums = np.zeros(len(self.ids), np.int64)
        self.windows = np.arange(0, len(self.ids) + WINDOW, WINDOW)
        self.long: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def list(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[s], self.starts[s + 1]
        return self.docs[a:b], self.gain[a:b]

    def skips(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each window begins in a long list, and its largest gain in it."""
        if s not in self.long:
            docs, gain = self.list(s)
            at = np.searchsorted(docs, self.windows)
            most = np.zeros(len(at) - 1, np.int64)
            has = at[1:] > at[:-1]
            most[has] = np.maximum.reduceat(gain, at[:-1][has])
            self.long[s] = at, most
        return self.long[s]


def better(scores: np.ndarray, ids: np.ndarray, more_scores: np.ndarray, more_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of both, by score descending and id ascending."""
    scores, ids = np.concatenate([scores, more_scores]), np.concatenate([ids, more_ids])
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def hybrid(block: Block, terms: np.ndarray, weights: np.ndarray, top: tuple[np.ndarray, np.ndarray], k: int, chunk: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """``top`` (scores, ids) with the block's documents that belong there."""
    slots = block.slot[terms]
    has = (slots >= 0) & (weights > 0)
    slots, weights = slots[has], weights[has]
    if not len(slots):
        return top
    sizes = block.starts[slots + 1] - block.starts[slots]
    short = sizes <= max(WINDOW, len(block.ids) // 32)
    # Term at a time: the short lists' sums.
    sums = block.sums
    for s, w in zip(slots[short], weights[short], strict=True):
        docs, gain = block.list(s)
        sums[docs] += w * gain
    touched = np.flatnonzero(sums)
    least = max(1, int(top[0][-1]) if len(top[0]) == k else 1)
    if len(touched) >= k:
        least = max(least, int(np.partition(sums[touched], -k)[-k]))
    # Document at a time: the sums are one iterator beside the long lists.
    bound = np.zeros(len(block.windows) - 1, np.int64)
    np.maximum.at(bound, touched // WINDOW, sums[touched])
    lists = [(w, *block.list(s), *block.skips(s)) for s, w in zip(slots[~short], weights[~short], strict=True)]
    for w, _, _, _, most in lists:
        bound += w * most
    live = np.flatnonzero(bound >= least)
    while len(live):
        now, live = live[:chunk], live[chunk:]
        runs = np.split(now, np.flatnonzero(np.diff(now) > 1) + 1)
        for run in runs:
            lo, hi = int(run[0]) * WINDOW, min((int(run[-1]) + 1) * WINDOW, len(block.ids))
            scores = sums[lo:hi].copy()
            for w, docs, gain, at, _ in lists:
                a, b = at[run[0]], at[run[-1] + 1]
                scores[docs[a:b] - lo] += w * gain[a:b]
            good = np.flatnonzero(scores >= least)
            if len(good):
                top = better(*top, scores[good], block.ids[lo:hi][good], k)
                if len(top[0]) == k:
                    least = max(least, int(top[0][-1]))
        live = live[bound[live] >= least]
    sums[touched] = 0
    return top


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search_block(corpus: DataFrame, queries: list[tuple[str, list[bytes]]], k: int) -> DataFrame:
    """(query, id, score): the best of every task for each of a block of queries."""
    spark = corpus.sparkSession
    vocabulary = {t: n for n, t in enumerate(sorted({t for _, own in queries for t in own}))}
    known = spark.sparkContext.broadcast(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Builder(known.value)
        for batch in batches:
            texts = batch.column(1)
            for ident, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                block.add(ident, text.as_py())
                if block.full():
                    yield block.row()
                    block = Builder(known.value)
        if block.n_docs:
            yield block.row()

    blocks = materialize(corpus.mapInArrow(index, BLOCK))
    whole = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    pairs = blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("p")).groupBy("p.terms").agg(F.sum("p.df").alias("df"))
    n_docs, n_terms = whole["n"] or 0, whole["l"] or 0
    weights = np.zeros(len(vocabulary), np.int64)
    for r in pairs.collect():  # at most the terms of a block of queries
        weights[r["terms"]] = weight(n_docs, r["df"])
    asked = [np.unique([vocabulary[t] for t in own], return_counts=True) for _, own in queries]
    shared = spark.sparkContext.broadcast((asked, weights))
    out = pa.schema([("query", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights = shared.value
        none = np.zeros(0, np.int64)
        tops = [(none, none)] * len(asked)
        for batch in batches:
            for payload in batch.column(0):
                block = Block(payload.as_py(), n_docs, n_terms, len(weights))
                for q, (terms, repeats) in enumerate(asked):
                    tops[q] = hybrid(block, terms, weights[terms] * repeats, tops[q], k)
        for q, (scores, ids) in enumerate(tops):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), q, np.int32)), pa.array(ids), pa.array(scores)], schema=out)

    found = blocks.select("payload").mapInArrow(search, "query int, id long, score long")
    names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(queries)], "query int, item string")
    return ranked(found, ["query"], k).join(names, "query")


def ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k best per query with their rank, in two levels."""
    order = [F.desc("score"), F.asc("id")]
    part = found.withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    some = part.withColumn("rank", F.row_number().over(Window.partitionBy(*by, "__salt").orderBy(*order))).filter(F.col("rank") <= k)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return best.filter(F.col("rank") <= k).drop("__salt")


def search(docs: DataFrame, benchmark: DataFrame, k: int = 20, text: str = "text", ident: str = "doc_id", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a
    score above 0 for each item."""
    corpus = docs.select(F.col(ident).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    asked = materialize(benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col(item_text), F.lit("")).cast("binary").alias("text")).distinct())
    size = asked.agg(F.sum(F.octet_length("text") + 64).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // QUERY_BYTES))
    out = None
    for p in range(parts):
        rows = asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == p).collect()  # about QUERY_BYTES
        queries = sorted(((r["item"], terms_of(bytes(r["text"]))) for r in rows), key=lambda q: (q[0] is not None, q))
        found = search_block(corpus, [q for q in queries if q[1]], k)
        out = found if out is None else out.unionAll(found)
    doc = F.when(F.col("id") != LEAST, F.col("id"))
    return out.select(F.col("item").cast(benchmark.schema[item].dataType).alias("item_id"), "rank", doc.alias("doc_id"), "score")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS (SELECT item_id, term, count(*) AS times FROM b GROUP BY ALL),
c AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
p AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, c GROUP BY term),
g AS (SELECT rid, doc_id, p.term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))) AS gain FROM p JOIN w USING (term), c),
s AS (SELECT item_id, rid, doc_id, sum(gain * times)::BIGINT AS score FROM g JOIN q USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 20
"""
