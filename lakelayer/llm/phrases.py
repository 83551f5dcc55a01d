"""Phrase collocations, counted in HAT-tries.

Each position of a text gives one suffix: its word and up to ``longest`` - 1
words behind it, within its piece.  A task counts the suffixes of a language
in a HAT-trie: a shallow trie over word ids whose leaves are hash containers.
A container covers a range of the next word ids; one that outgrows ``BURST``
entries bursts, in two by its ids, or, if it covers one id only, into a node
one word deeper.  When the trie holds ``MEMORY`` entries, its largest subtrees
leave as sorted runs, cut at splitters into prefix partitions: ranges of the
order of suffixes, at quantiles of a size-weighted sample.  A hot prefix thus
spans many partitions; copies of a suffix meet in the containers.

The runs of a partition are merged and every prefix of the suffixes summed up:
the number of occurrences of each phrase.  All phrases of a range but the first
and the last of each length lie wholly inside it; sums over the partitions
complete those two.  Phrases of ``least`` occurrences go on to plain joins for
scores and nested phrases: parts and extensions that matter are as frequent.

Only splitters reach the driver: one per ``RANGE`` suffixes, each from ``DRAWN``
samples.  Memory of a task: a trie of ``MEMORY`` entries or a range's runs.
Scores are exact decimals while 1000 * a * n < 10^38.

Defined results: NULL text has no words; NULL language is ``und``; rows count
as often as they are repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import materialize

BURST = 16_384
MEMORY = 500_000
RANGE = 1_000_000
DRAWN = 64
BLOCK = 500_000  # words that enter the trie together
SALTS = 64
BREAK = 255  # a byte that UTF-8 doesn't use
PIECE_BYTES = bytes(BREAK if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else 32 if b == 9 else b for b in range(256))
RUN = "range int, lang string, payload binary"


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased words, and a BREAK byte where a piece ends."""
    return raw.translate(PIECE_BYTES).replace(b"\xff", b" \xff ").split()


def chunks(raw: bytes, size: int = 4_000_000) -> Iterator[bytes]:
    """A long text in parts that end where a piece does."""
    at = 0
    while len(raw) - at > size:
        end = min((e for e in (raw.find(c, at + size) for c in (b".", b",", b"\n")) if e >= 0), default=-1)
        if end < 0:
            break
        yield raw[at : end + 1]
        at = end + 1
    yield raw[at:]


class WordIds(dict):
    """Word -> id from 1 on; the break is 0."""

    def __init__(self):
        super().__init__({b"\xff": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Node:
    """Inner node at a depth: ``kids[i]`` covers the word ids from ``edges[i]`` on."""

    def __init__(self, depth: int, kid: Counter):
        self.depth, self.edges, self.kids = depth, [0], [kid]


class HatTrie:
    """Counts rows of ``width`` word ids, 0 behind the end of a row."""

    def __init__(self, width: int):
        self.width, self.root, self.entries = width, Node(0, Counter()), 0

    def keys(self, container: Counter, depth: int) -> np.ndarray:
        return np.frombuffer(b"".join(container), dtype="<i4").reshape(len(container), self.width - depth)

    def add(self, rows: np.ndarray, node: Node | None = None) -> None:
        node = node or self.root
        d = node.depth
        rows = rows[np.argsort(rows[:, d], kind="stable")]
        cuts = [0, *np.searchsorted(rows[:, d], node.edges[1:]).tolist(), len(rows)]
        for i in reversed(range(len(node.kids))):  # a burst moves only those behind
            part = rows[cuts[i] : cuts[i + 1]]
            if not len(part):
                continue
            kid = node.kids[i]
            if isinstance(kid, Node):
                self.add(part, kid)
                continue
            before = len(kid)
            rest = np.ascontiguousarray(part[:, d:], dtype="<i4")
            kid.update(rest.view(np.dtype((np.void, rest.shape[1] * 4))).ravel().tolist())
            self.entries += len(kid) - before
            self.burst(node, i)

    def burst(self, node: Node, i: int) -> None:
        """Splits container ``i`` until none of its pieces is over BURST."""
        container, d = node.kids[i], node.depth
        if len(container) <= BURST or d + 1 >= self.width:
            return
        firsts = self.keys(container, d)[:, 0]
        lo, hi = int(firsts.min()), int(firsts.max())
        behind = node.edges[i + 1] if i + 1 < len(node.edges) else None
        if lo == hi:  # one id: a node one word deeper, empty containers beside it
            child = Node(d + 1, Counter({k[4:]: n for k, n in container.items()}))
            parts = [(node.edges[i], Counter())] if node.edges[i] < lo else []
            parts.append((lo, child))
            if behind is None or behind > lo + 1:
                parts.append((lo + 1, Counter()))
            self.burst(child, 0)
        else:
            middle = max(lo + 1, int(np.median(firsts)))
            halves = (Counter(), Counter())
            for (key, n), up in zip(container.items(), (firsts >= middle).tolist(), strict=True):
                halves[up][key] = n
            parts = [(node.edges[i], halves[0]), (middle, halves[1])]
        node.edges[i : i + 1] = [e for e, _ in parts]
        node.kids[i : i + 1] = [k for _, k in parts]
        if lo < hi:
            self.burst(node, i + 1)
            self.burst(node, i)

    def rows(self, kid: Node | Counter, path: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The rows and counts of a subtree below the ids of ``path``."""
        if isinstance(kid, Node):
            for edge, own in zip(kid.edges, kid.kids, strict=True):
                yield from self.rows(own, (*path, edge) if isinstance(own, Node) else path)
        elif kid:
            keys = self.keys(kid, len(path))
            whole = np.concatenate([np.broadcast_to(np.array(path, "<i4"), (len(keys), len(path))), keys], axis=1)
            yield whole, np.fromiter(kid.values(), np.int64, len(kid))

    def size(self, kid: Node | Counter) -> int:
        return sum(map(self.size, kid.kids)) if isinstance(kid, Node) else len(kid)

    def take(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Takes out the largest subtrees of the root, ``least`` entries at least (all,
        if fewer): their rows and counts."""
        out, root = [], self.root
        sizes = [self.size(k) for k in root.kids]
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            if least <= 0 or not sizes[i]:
                break
            out += self.rows(root.kids[i], (root.edges[i],) if isinstance(root.kids[i], Node) else ())
            root.kids[i] = Counter()
            least -= sizes[i]
            self.entries -= sizes[i]
        if not out:
            return np.zeros((0, self.width), "<i4"), np.zeros(0, np.int64)
        return np.concatenate([r for r, _ in out]), np.concatenate([c for _, c in out])


def in_order(rows: np.ndarray, most: int) -> np.ndarray:
    """The order of the rows of ids up to ``most``."""
    bits = max(1, int(most).bit_length())
    per = max(1, 62 // bits)  # columns that fit a 64-bit key
    keys = []
    for at in range(0, rows.shape[1], per):
        k = np.zeros(len(rows), np.int64)
        for j in range(at, min(at + per, rows.shape[1])):
            k = (k << bits) | rows[:, j]
        keys.append(k)
    return np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")


def pack(words: list[bytes], rows: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run: its words in order, and its rows as places among them, from 1."""
    import zstandard

    used, places = np.unique(rows, return_inverse=True)
    own = [words[i - 1] for i in used.tolist() if i]
    places = places.reshape(rows.shape) + (0 if len(used) and used[0] == 0 else 1)
    kind, number = np.min_scalar_type(len(own)), np.min_scalar_type(int(counts.max()))
    names = b" ".join(own)
    head = np.array([len(names), len(rows), kind.itemsize, number.itemsize], "<i8").tobytes()
    columns = b"".join(np.ascontiguousarray(c).astype(kind).tobytes() for c in places.T)
    return zstandard.ZstdCompressor(level=3).compress(head + names + columns + counts.astype(number).tobytes())


def unpack(payload: bytes, width: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(payload)
    names, n, kind, number = np.frombuffer(raw, "<i8", 4).tolist()
    words = raw[32 : 32 + names].split(b" ")
    rows = np.frombuffer(raw, f"<u{kind}", n * width, 32 + names).reshape(width, n).T
    return words, rows, np.frombuffer(raw, f"<u{number}", n, 32 + names + rows.nbytes).astype(np.int64)


def suffixes(ids: np.ndarray, width: int) -> np.ndarray:
    """A row per word: it and what follows in its piece, 0 behind the end."""
    n = len(ids)
    padded = np.concatenate([ids, np.zeros(width, ids.dtype)])
    rows = np.stack([padded[j : j + n] for j in range(width)], axis=1)
    over = np.zeros(n, bool)
    for j in range(width):
        over |= rows[:, j] == 0
        rows[over, j] = 0
    return rows[rows[:, 0] > 0]


class Counting:
    """The trie of one language in one task."""

    def __init__(self, width: int):
        self.width, self.trie, self.ids, self.open = width, HatTrie(width), WordIds(), []

    def add(self, raw: bytes) -> bool:
        """Counts a text; whether the trie is full."""
        for part in chunks(raw):
            self.open += map(self.ids.__getitem__, words_of(part))
            self.open.append(0)
            if len(self.open) >= BLOCK:
                self.flush()
        return self.trie.entries >= MEMORY

    def flush(self) -> None:
        self.trie.add(suffixes(np.array(self.open, dtype="<i4"), self.width))
        self.open = []

    def spill(self, lang: str, splitters: list[tuple[str, tuple[bytes, ...]]], least: int) -> Iterator[dict]:
        """Sorted runs of the largest subtrees, cut at the splitters."""
        rows, counts = self.trie.take(least)
        if not len(rows):
            self.ids = self.ids if self.open else WordIds()
            return
        names = list(self.ids)
        used = np.unique(rows)
        used = used[used > 0]
        order = sorted(used.tolist(), key=names.__getitem__)
        words = [names[i] for i in order]
        place = np.zeros(len(names), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        rows = place[rows]
        sort = in_order(rows, len(words))
        rows, counts = rows[sort], counts[sort]
        cuts, first = [0], bisect.bisect_left(splitters, (lang,))

        def between(word: bytes) -> int:
            i = bisect.bisect_left(words, word)
            return 2 * i + 2 if i < len(words) and words[i] == word else 2 * i + 1

        for at, suffix in splitters[first:]:
            if at != lang:
                break
            key = [between(w) for w in suffix] + [0] * (self.width - len(suffix))
            cuts.append(bisect.bisect_left(range(len(rows)), key, key=lambda k: (2 * rows[k]).tolist()))
        for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(rows)], strict=True)):
            if a < b:
                yield {"range": first + i, "lang": lang, "payload": pack(words, rows[a:b], counts[a:b])}
        if not self.trie.entries and not self.open:
            self.ids = WordIds()


def run_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("range", pa.int32()), ("lang", pa.string()), ("payload", pa.binary())]))


def runs(slim: DataFrame, splitters: list[tuple[str, tuple[bytes, ...]]], width: int) -> DataFrame:
    """(range, lang, payload): the tasks' sorted runs of (lang, text)."""
    shared = slim.sparkSession.sparkContext.broadcast(splitters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting: dict[str, Counting] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = counting.get(lang) or counting.setdefault(lang, Counting(width))
                own.add(text.as_py())
                while sum(c.trie.entries for c in counting.values()) >= MEMORY:
                    most = max(counting, key=lambda k: counting[k].trie.entries)
                    for row in counting[most].spill(most, shared.value, MEMORY // 2):
                        yield run_batch([row])
                if sum(len(c.ids) for c in counting.values()) >= MEMORY:  # too many different words
                    most = max(counting, key=lambda k: len(counting[k].ids))
                    counting[most].flush()
                    for row in counting[most].spill(most, shared.value, counting[most].trie.entries):
                        yield run_batch([row])
        for lang, own in counting.items():
            own.flush()
            for row in own.spill(lang, shared.value, own.trie.entries):
                yield run_batch([row])

    return slim.mapInArrow(count, RUN)


def splitters_of(slim: DataFrame, width: int) -> list[tuple[str, tuple[bytes, ...]]]:
    """Quantiles of a sample of suffixes: texts drawn with chances in proportion to
    their size, each giving as many suffixes as times it is drawn."""
    total = slim.agg(F.sum(F.octet_length("text") + 1).alias("n")).first()["n"] or 0
    parts = total // 6 // RANGE + 1
    if parts == 1:
        return []
    times = F.floor(F.octet_length("text") * (parts * DRAWN / total) + F.rand(7)).cast("int")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng, rows = random.Random(TaskContext.get().partitionId()), []
        for batch in batches:
            for lang, text, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = words_of(text.as_py())
                at = [k for k, w in enumerate(words) if w != b"\xff"]
                for k in rng.choices(at, k=n) if at else ():
                    own = words[k : k + width]
                    rows.append({"lang": lang, "suffix": b" ".join(own[: own.index(b"\xff")] if b"\xff" in own else own)})
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("lang", pa.string()), ("suffix", pa.binary())]))

    drawn = slim.withColumn("times", times).filter("times > 0").mapInArrow(draw, "lang string, suffix binary").collect()
    points = sorted((r["lang"], tuple(bytes(r["suffix"]).split(b" "))) for r in drawn)
    return sorted({points[len(points) * k // parts] for k in range(1, parts)}) if points else []


def phrases_of(runs_: DataFrame, width: int, least: int) -> DataFrame:
    """(lang, size, phrase, f): phrases of ``least`` occurrences and more; size 0 is all words."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, own in pdf.groupby("lang", sort=False):
            parts = [unpack(p, width) for p in own["payload"]]
            words = sorted(set().union(*(p[0] for p in parts)))
            place = {w: k for k, w in enumerate(words, 1)}
            rows = np.concatenate([np.fromiter([0, *(place[w] for w in own_words)], np.int64)[r] for own_words, r, _ in parts])
            counts = np.concatenate([p[2] for p in parts])
            sort = in_order(rows, len(words))
            rows, counts = rows[sort], counts[sort]
            new = np.zeros(len(rows), bool)
            new[0] = True
            for size in range(width + 1):
                if size:
                    new[1:] |= rows[1:, size - 1] != rows[:-1, size - 1]
                heads = np.flatnonzero(new)
                sums = np.add.reduceat(counts, heads)
                if size:
                    real = rows[heads, size - 1] > 0
                    heads, sums = heads[real], sums[real]
                keep = sums >= least
                keep[:1] = keep[-1:] = True  # may go on in the ranges beside
                for h, f in zip(heads[keep].tolist(), sums[keep].tolist(), strict=True):
                    out.append((lang, size, b" ".join(words[i - 1] for i in rows[h, :size]).decode(), f))
        return pd.DataFrame(out, columns=["lang", "size", "phrase", "f"])

    parts = runs_.groupBy("range").applyInPandas(merge, "lang string, size int, phrase string, f long")
    return parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).filter((F.col("size") == 0) | (F.col("f") >= least))


def collocations(grams: DataFrame, nested_percent: int) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that aren't nested."""
    n = grams.filter("size = 0").select("lang", F.col("f").alias("n"))
    phrases = grams.filter("size > 0").select("lang", "phrase", "f")
    candidates = grams.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def part(first: Column, count: Column) -> Column:
        return F.array_join(F.slice("w", first, count), " ")

    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]).join(n, "lang")
    cut = cut.withColumn("score", F.expr("((1000Q * a) * n) div (CAST(l AS DECIMAL(19, 0)) * r)".replace("1000Q", "CAST(1000 AS DECIMAL(4, 0))")).cast("long"))
    scored = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"))
    # A phrase nested in a longer one is nested in one longer by a word, too.
    longer = candidates.filter("size > 2").select("lang", "a", F.explode(F.array(part(F.lit(1), F.col("size") - 1), part(F.lit(2), F.col("size") - 1))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(~F.coalesce(F.col("longer") * 100 >= F.col("a") * nested_percent, F.lit(False)))
    return kept.select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, top: int = 2000, nested_percent: int = 100) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: each language's ``top``
    collocations of 2 to ``longest`` words by score, then by a, then by phrase."""
    slim = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    splitters = splitters_of(slim, longest)
    grams = materialize(phrases_of(runs(slim, splitters, longest), longest, least))
    scored = materialize(collocations(grams, nested_percent))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
s AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM i, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, k AS size, phrase, count(*) AS f FROM s GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1),
u AS (SELECT *, unnest(range(1, size)) AS k FROM c),
x AS (SELECT u.*, l.f AS l, r.f AS r, n, ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score FROM u
      JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(u.w[1:u.k], ' ')
      JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(u.w[u.k + 1:], ' ') JOIN n ON n.lang = u.lang),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score FROM b
WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.size > b.size AND c.a >= b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
QUALIFY rank <= 2000
"""
