"""SimHash near-duplicates with pigeonring filtering.

A fingerprint's 64 bits are cut into 4 segments on a ring.  Of two fingerprints
at most ``LIMIT`` (3) bits apart, some segment starts a chain along the ring
whose first l segments differ by at most l * 3 / 4 bits in sum, for every l:
0 bits in the first segment, at most 1 in two, 2 in three, 3 in all four.
Candidates must therefore agree in one segment and differ by at most one bit
in the next: that chain of two is the search key (32 bits, and for
fingerprints of even parity the 16 neighbours of the second segment; if the
second segments differ by one bit, exactly one of the pair is even there).
The chain of three and the full Hamming distance are checked in the bucket.

Only different fingerprints are searched.  A bucket returns a spanning forest
of its links, never all pairs.  A bucket over ``SPLIT`` fingerprints is cut by
eight further bits: of two members that agree in 32 bits and differ by at most 3
of the other 32, one of four further bytes agrees (32 + 8 bits fixed: a bucket
then holds at most 2 ** 24 fingerprints).  Components come from alternating
large-star / small-star passes, each written to the shared folder.

Defined results: NULL or empty text and texts without words have fingerprint
zero and are linked like any other; repeated rows have one component; a
component of NULL ids only has component_id NULL; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import materialize

LIMIT = 3
SEGMENTS = 4
WIDTH = 16
SPLIT = 20_000
STEP = 1 << 18


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """Bit b is 1 if over half of the shingles' XXH64 have it."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words)
    if not n:
        return 0
    if n < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    runs = n - shingle + 1
    ones = np.zeros(64, dtype=np.int64)
    digest, join = xxhash.xxh64_digest, b" ".join
    for at in range(0, runs, STEP):
        part = b"".join([digest(join(words[k : k + shingle]), 42) for k in range(at, min(at + STEP, runs))])
        ones += np.unpackbits(np.frombuffer(part, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int("".join("1" if 2 * x > runs else "0" for x in ones), 2)


def with_fingerprint(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``docs`` plus __fp, the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint_of(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.withColumn("__fp", fingerprints(text))


def rotated(x: np.ndarray, first: int) -> np.ndarray:
    """The ring turned so that segment ``first`` comes first (highest bits)."""
    left = WIDTH * first
    return (x << np.uint64(left)) | (x >> np.uint64(64 - left)) if left else x


def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Search keys of different fingerprints: (key, fp, own).  Own keys are all
    found by each other; a neighbour key finds own keys only."""
    flips = np.r_[np.uint64(0), np.uint64(1) << np.arange(WIDTH, dtype=np.uint64)]
    for b in batches:
        x = b["fp"].to_numpy(np.int64).view(np.uint64)
        for first in range(SEGMENTS):
            chain = rotated(x, first) >> np.uint64(64 - 2 * WIDTH)
            even = (np.bitwise_count(chain & np.uint64((1 << WIDTH) - 1)) & 1) == 0
            for flip in flips:
                pick = slice(None) if flip == 0 else even
                key = (np.uint64(first) << np.uint64(2 * WIDTH)) | (chain[pick] ^ flip)
                yield pd.DataFrame({"key": key.view(np.int64), "part": np.int32(-1), "fp": x[pick].view(np.int64), "own": flip == 0})


def linked(x: np.uint64, others: np.ndarray) -> np.ndarray:
    """Members at most LIMIT bits away."""
    return np.bitwise_count(others ^ x) <= LIMIT


def chained(x: np.uint64, others: np.ndarray, first: int) -> np.ndarray:
    """Members whose chain of three segments from ``first`` stays within its budget."""
    d = rotated(others ^ x, first) >> np.uint64(WIDTH)
    return np.bitwise_count(d) <= LIMIT * 3 // SEGMENTS


def forest(own: np.ndarray, near: np.ndarray, first: int, prune: bool = True) -> Iterator[tuple[int, int]]:
    """Spanning forest of the links among ``own`` and from ``near`` to ``own``:
    what a fingerprint reaches leaves the search, so the links returned are
    fewer than the members."""
    members = np.concatenate([own, near])
    is_own = np.arange(len(members)) < len(own)
    todo = np.ones(len(members), dtype=bool)
    for start in range(len(own)):
        if not todo[start]:
            continue
        todo[start] = False
        stack = [start]
        while stack:
            at = stack.pop()
            rest = np.flatnonzero(todo if is_own[at] else todo & is_own)
            if not len(rest):
                continue
            others = members[rest]
            hit = linked(members[at], others)
            if prune:
                hit &= chained(members[at], others, first)
            for k in rest[hit]:
                todo[k] = False
                stack.append(int(k))
                yield int(members[at]), int(members[k])


def bucket_links(key: int, own: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    return list(forest(own, near, key >> (2 * WIDTH)))


def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of the buckets of one partition, sorted by (key, part, not own, fp)."""
    held = None

    def links(b: pd.DataFrame) -> pd.DataFrame:
        key, part = b["key"].to_numpy(np.int64), b["part"].to_numpy(np.int32)
        fp, own = b["fp"].to_numpy(np.int64).view(np.uint64), b["own"].to_numpy(bool)
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])])
        size = np.diff(np.r_[start, len(key)])
        owns = np.add.reduceat(own.astype(np.int64), start)
        found = []
        for s, n, o in zip(*(v[(size > 1) & (owns > 0)].tolist() for v in (start, size, owns)), strict=True):
            if n == 2:
                x, y = fp[s], fp[s + 1]
                if int(x ^ y).bit_count() <= LIMIT:
                    found.append((int(x), int(y)))
            else:
                found += bucket_links(int(key[s]), fp[s : s + o], fp[s + o : s + n])
        pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"u": pairs.min(axis=1), "v": pairs.max(axis=1)})

    for b in batches:
        held = b if held is None else pd.concat([held, b], ignore_index=True)
        last = (held["key"] == held["key"].iat[-1]) & (held["part"] == held["part"].iat[-1])
        if not last.all():
            yield links(held[~last])
            held = held[last].reset_index(drop=True)
    if held is not None and len(held):
        yield links(held)


def further(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members of an overfull bucket by each byte outside the search key.  A
    neighbour's own bit off the key leaves at most 2 differing bits there, so
    one of the four bytes agrees in any case."""
    for b in batches:
        x = b["fp"].to_numpy(np.int64).view(np.uint64)
        first = b["key"].to_numpy(np.int64) >> (2 * WIDTH)
        left = (np.uint64(WIDTH) * first.astype(np.uint64)) % np.uint64(64)
        turned = np.where(left > 0, (x << left) | (x >> ((np.uint64(64) - left) % np.uint64(64))), x)
        for byte in range(4):
            value = (turned >> np.uint64(8 * byte)) & np.uint64(255)
            yield b.assign(part=(value.astype(np.int32) + 256 * byte).astype(np.int32))


def links(prints: DataFrame, split: int = SPLIT) -> DataFrame:
    """Spanning links (u, v) between different fingerprints (column ``fp``)."""
    spark = prints.sparkSession
    schema = "key long, part int, fp long, own boolean"
    keys = prints.select("fp").mapInPandas(probes, schema)
    keys = materialize(keys, "lz4")
    hot = materialize(keys.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > split).select("key"))
    plain = keys
    if hot.limit(1).count():
        parts = keys.join(hot, "key", "left_semi").mapInPandas(further, schema)
        plain = keys.join(hot, "key", "left_anti").unionAll(parts)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = plain.repartition(n, "key", "part").sortWithinPartitions("key", "part", F.desc("own"), "fp")
    return dealt.mapInPandas(search, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v), root the smallest of its
    component, by large-star and small-star passes until nothing changes."""
    edges = materialize(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct()
        large = materialize(large)
        # Every node points at smaller ones: bring them under the smallest.
        root = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(root, "v").select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b")).filter("a <> b")
        after = materialize(small.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
        same = [x.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first() for x in (edges, after)]
        edges = after
        if same[0] == same[1]:
            return edges.select(F.col("v").alias("node"), F.col("u").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", ident: str = "doc_id", shingle: int = 3) -> DataFrame:
    """``docs`` without ``text``, plus fingerprint (16 hex digits), component_id
    (the smallest id of the component) and __root (the component's key, also for
    NULL ids)."""
    df = with_fingerprint(docs.drop("fingerprint", "component_id"), text, shingle).drop(text)
    df = materialize(df)
    prints = materialize(df.groupBy(F.col("__fp").alias("fp")).agg(F.min(ident).alias("least")))
    roots = components(links(prints))
    prints = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("__root"))
    least = prints.groupBy("__root").agg(F.min("least").alias("component_id"))
    prints = prints.join(least, "__root").select(F.col("fp").alias("__fp"), "__root", "component_id")
    df = df.join(prints, "__fp")
    return df.withColumn("fingerprint", F.lower(F.lpad(F.hex("__fp"), 16, "0"))).drop("__fp")


def one_of_each(docs: DataFrame, text: str = "text", ident: str = "doc_id", shingle: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the smallest id's; of rows that
    repeat this id, one."""
    hashed = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in docs.columns])
    slim = docs.select(F.col(ident).alias("__id"), hashed.alias("__row"), F.col(text).alias("__t"))
    rows = near_duplicates(slim, "__t", "__id", shingle).groupBy("__root", "__id", "__row").agg(F.count("*").alias("__n"))
    first = F.struct(F.col("__id").isNull(), "__id", "__row")
    keep = rows.groupBy("__root").agg(F.min_by(F.struct("__id", "__row", "__n"), first).alias("k")).select("k.__id", "k.__row", "k.__n")
    keep = materialize(keep)
    on = (F.col("__row") == hashed) & F.col("__id").eqNullSafe(F.col(ident))
    kept = docs.join(keep.filter("__n = 1"), on, "left_semi")
    if keep.filter("__n > 1").limit(1).count():  # rows that repeat in every column: one stays
        kept = kept.unionAll(docs.join(keep.filter("__n > 1"), on, "left_semi").dropDuplicates())
    return kept
