"""Language-model scoring with Elias-Fano n-gram tries.

The model is a bigram model with Dirichlet smoothing,

    P(w|u) = (c(uw) + M * P(w)) / (c(u) + M),    P(w) = (c(w) + 1) / (N + V + 1),

learnt from all training texts.  It is never in one place: the pairs are dealt
to shards by their context, and one shard's trie is built, queried and dropped
in one task.  Frequent contexts are dealt by context and successor; which
contexts count as frequent (from a sample) decides the placement only.

A shard's trie has flat, read-only levels that can be memory-mapped:

    words      sorted 64-bit hashes; a word's id is its place
    unigrams   quantised log10 P(w) and log10 of the backoff weight M / (c(u) + M)
    pointers   Elias-Fano: where a context's successors begin
    successors Elias-Fano: successor ids, made monotone by adding the last value
               of the context before, so a successor is searched relative to
               its context in one monotone sequence
    pairs      quantised log10 P(w|u)

A pair that is not in the trie is scored by the backoff weight and the unigram.

Jobs: (1) words of all texts to word buckets, with the shards that will ask
for them; (2) merged counts back to those shards; (3) the pairs of all texts,
in compressed blocks, to their shards, which answer with sums per document;
(4) the sums of a document's block are added up.  The data move as blocks of
arrays; a document takes part whole, however long.

Defined results: NULL or empty text is the end token alone; rows are scored one
by one, repeated rows and NULL ids included; without training texts every
score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import io
import mmap
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import materialize, words

MASS = 300.0  # M
END, START = b"\n", b"\n\n"  # no word holds white space
SHARD_BYTES = 16 << 20
STEP_TOKENS = 3 << 20
STEP_BYTES = 16 << 20
SAMPLE_BYTES = 8 << 20
PART = 1 << 16  # values coded at a time; a whole number of bytes
SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed block."""
    import zstandard

    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.ZstdCompressor(level=1).compress(out.getvalue())


def unpack(block: bytes) -> dict[str, np.ndarray]:
    import zstandard

    with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(block))) as z:
        return {k: z[k] for k in z.files}


def narrow(a: np.ndarray) -> np.ndarray:
    """The same numbers in the least unsigned type."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


class EliasFano:
    """A monotone sequence: lower bits in full, upper bits as gaps in unary."""

    def __init__(self, low: np.ndarray, high: np.ndarray, meta: np.ndarray):
        self.low, self.high, self.n, self.bits = low, high, int(meta[0]), int(meta[1])

    @staticmethod
    def encode(values: np.ndarray) -> dict[str, np.ndarray]:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(0, dtype=np.uint8)
        if bits and n:
            places = np.arange(bits, dtype=np.uint64)
            low = np.concatenate([np.packbits(((values[at : at + PART, None] >> places) & np.uint64(1)).astype(np.uint8).ravel()) for at in range(0, n, PART)])
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[ones] = 1
        return {"low": low, "high": np.packbits(unary), "meta": np.array([n, bits], dtype=np.int64)}

    def decode(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            weights = (np.uint64(1) << np.arange(self.bits, dtype=np.uint64)).astype(np.uint64)
            for at in range(0, self.n, PART):
                n = min(PART, self.n - at)
                part = np.unpackbits(self.low[at * self.bits // 8 : -(-(at + n) * self.bits // 8)])[: n * self.bits]
                out[at : at + n] |= part.reshape(n, self.bits).astype(np.uint64) @ weights
        return out


QUANTA = np.iinfo(np.uint16).max


def quantise(logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 values (at most 0) as 16-bit steps of the least one."""
    least = float(logs.min()) if len(logs) else 0.0
    step = least / QUANTA if least < 0 else -1.0
    return np.rint(logs / step).astype(np.uint16), np.array([step])


class Trie:
    """Levels of one shard, over a block of bytes or a memory-mapped file."""

    LEVELS = ("words", "unigram", "unigram_step", "backoff", "backoff_step", "pointer_low", "pointer_high", "pointer_meta", "successor_low", "successor_high", "successor_meta", "pair", "pair_step")

    def __init__(self, buffer):
        view = memoryview(buffer)
        n = len(self.LEVELS)
        table = np.frombuffer(view[: n * 24], dtype=np.int64).reshape(n, 3)
        kinds = (np.uint64, np.uint16, np.float64, np.uint8, np.int64)
        self.level = {name: np.frombuffer(view[at : at + size], dtype=kinds[kind]) for name, (at, size, kind) in zip(self.LEVELS, table.tolist(), strict=True)}
        self.pointers = EliasFano(*[self.level[f"pointer_{k}"] for k in ("low", "high", "meta")]).decode().astype(np.int64)
        self.successors = EliasFano(*[self.level[f"successor_{k}"] for k in ("low", "high", "meta")]).decode()
        # Per context, the value that its successors are relative to.
        last = np.zeros(len(self.pointers), dtype=np.uint64)
        filled = np.flatnonzero(np.diff(self.pointers))
        last[filled + 1] = self.successors[self.pointers[filled + 1] - 1] + np.uint64(1)
        self.base = np.maximum.accumulate(last)

    @classmethod
    def open(cls, path: str) -> Trie:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    @staticmethod
    def build(hashes: np.ndarray, counts: np.ndarray, context_counts: np.ndarray, total: int, kinds: int, context: np.ndarray, word: np.ndarray, pairs: np.ndarray, mass: float = MASS) -> bytes:
        """Levels from the shard's words (sorted hashes, their counts as words and
        as contexts) and its counted pairs (ids, sorted by context and word)."""
        p = (counts + 1) / (total + kinds + 1)
        unigram, unigram_step = quantise(np.log10(p))
        backoff, backoff_step = quantise(np.log10(mass / (context_counts + mass)))
        pair, pair_step = quantise(np.log10((pairs + mass * p[word]) / (context_counts[context] + mass)))
        pointers = np.searchsorted(context, np.arange(len(hashes) + 1))
        # A context's base: the value that the context before ended at.
        last = np.zeros(len(hashes) + 1, dtype=np.int64)
        filled = np.flatnonzero(np.diff(pointers))
        ends = np.cumsum(word[pointers[filled + 1] - 1].astype(np.int64) + 1)
        last[filled + 1] = ends
        base = np.maximum.accumulate(last)
        parts = {
            "words": hashes.astype(np.uint64), "unigram": unigram, "unigram_step": unigram_step, "backoff": backoff, "backoff_step": backoff_step,
            **{f"pointer_{k}": v for k, v in EliasFano.encode(pointers).items()},
            **{f"successor_{k}": v for k, v in EliasFano.encode(base[context] + word).items()},
            "pair": pair, "pair_step": pair_step,
        }
        kind = {np.dtype(np.uint64): 0, np.dtype(np.uint16): 1, np.dtype(np.float64): 2, np.dtype(np.uint8): 3, np.dtype(np.int64): 4}
        table, body, at = [], [], len(Trie.LEVELS) * 24
        for name in Trie.LEVELS:
            raw = np.ascontiguousarray(parts[name]).tobytes()
            table.append((at, len(raw), kind[parts[name].dtype]))
            body.append(raw + b"\0" * (-len(raw) % 8))
            at += len(body[-1])
        return np.array(table, dtype=np.int64).tobytes() + b"".join(body)

    def score(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 P(word|context) for ids of the shard's words."""
        level = self.level
        out = level["backoff"][context] * level["backoff_step"] + level["unigram"][word] * level["unigram_step"]
        if len(self.successors):
            wanted = self.base[context] + word.astype(np.uint64)
            at = np.searchsorted(self.successors, wanted)
            inside = at < self.pointers[context + 1]
            at = np.where(inside, at, 0)
            found = inside & (self.successors[at] == wanted) & (at >= self.pointers[context])
            out = np.where(found, level["pair"][at] * level["pair_step"], out)
        return out


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit hashes for placement."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def shard_of(context: np.ndarray, word: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """A pair's shard: by the context, of a hot context by the successor too."""
    split = np.isin(context, hot) if len(hot) else np.zeros(len(context), dtype=bool)
    return (mix(np.where(split, context ^ mix(word), context)) % np.uint64(shards)).astype(np.int32)


def pieces(text: str | None) -> Iterator[tuple[list[bytes], bool]]:
    """Words of a text in parts cut at white space; whether it is the last part."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    at = 0
    while len(data) - at > STEP_BYTES:
        cut = SPACE.search(data, at + STEP_BYTES)
        if cut is None:
            break
        yield data[at : cut.start()].split(), False
        at = cut.start()
    yield (data[at:] if at else data).split(), True


class Tokens:
    """Arrays of a block: hashes (of different words), word and context (places
    in hashes), doc (number in the block), and per document its row number in
    the partition, id, NULL flag and training flag."""

    def __init__(self):
        self.flat, self.chunks, self.n = [], [], 0
        self.heads, self.lengths, self.docs, self.rows = [], [], [], []

    def add_row(self, number: int, ident: int | None, train: bool) -> None:
        self.rows.append((number, ident, train))

    def add(self, tokens: list[bytes], before: bytes) -> None:
        """Tokens of the last row's text; ``before`` stands in front of them."""
        if tokens:
            self.heads.append(before)
            self.lengths.append(len(tokens))
            self.docs.append(len(self.rows) - 1)
            self.flat += tokens
            self.n += len(tokens)
            if len(self.flat) >= PART:
                self.shut()

    def shut(self) -> None:
        self.chunks.append(pa.array(self.flat, type=pa.binary()))
        self.flat = []

    def done(self) -> Tokens:
        import xxhash

        self.shut()
        coded = pa.concat_arrays([*self.chunks, pa.array(self.heads, type=pa.binary())]).dictionary_encode()
        self.chunks = []
        ids = coded.indices.to_numpy(zero_copy_only=False)
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
        self.word, heads = ids[: self.n], ids[self.n :]
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[np.cumsum([0, *self.lengths[:-1]])[: len(heads)]] = heads
        self.doc = np.repeat(np.array(self.docs, dtype=np.int32), self.lengths)
        self.row = np.array([r for r, _, _ in self.rows], dtype=np.int64)
        self.ids = np.array([0 if i is None else i for _, i, _ in self.rows], dtype=np.int64)
        self.null = np.array([i is None for _, i, _ in self.rows], dtype=bool)
        self.train = np.array([t for _, _, t in self.rows], dtype=bool)
        return self


def token_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    """Blocks of about STEP_TOKENS tokens.  A long text may go on in the next
    block, with the same row number."""
    block, number = Tokens(), -1
    for batch in batches:
        ids, texts, train = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
        for k, ident in enumerate(ids):
            number += 1
            block.add_row(number, ident, train[k])
            before = START
            for tokens, last in pieces(texts[k].as_py()):
                tokens = tokens + [END] if last else tokens
                block.add(tokens, before)
                before = tokens[-1] if tokens else before
                if block.n >= STEP_TOKENS:
                    yield block.done()
                    block = Tokens()
                    if not last:
                        block.add_row(number, ident, train[k])
    if block.rows:
        yield block.done()


def different(a: np.ndarray) -> np.ndarray:
    """Different values, sorted."""
    a = np.sort(a)
    return a[np.r_[True, a[1:] != a[:-1]]] if len(a) else a


def numbered(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values, sorted, and the number of each element's value."""
    order = np.argsort(a, kind="stable")
    a = a[order]
    new = np.r_[True, a[1:] != a[:-1]]
    number = np.empty(len(a), dtype=np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - 1
    return a[new], number


def word_counts(shards: int, hot: np.ndarray):
    """Job 1: per block and word bucket the words, their training counts and the
    shards that will ask for them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in token_blocks(batches):
            if not b.n:
                continue
            n = len(b.hashes)
            count = np.bincount(b.word[b.train[b.doc]], minlength=n)
            at = shard_of(b.hashes[b.context], b.hashes[b.word], hot, shards).astype(np.int64)
            asks = different(np.concatenate([different(b.word.astype(np.int64) * shards + at), different(b.context.astype(np.int64) * shards + at)]))
            asker, shard = asks // shards, asks % shards
            bucket = (mix(b.hashes ^ np.uint64(0x5BD1E995)) % np.uint64(shards)).astype(np.int32)
            order = np.argsort(bucket[asker], kind="stable")
            asker, shard = asker[order], shard[order]
            bounds = np.searchsorted(bucket[asker], np.arange(shards + 1))
            keys, blocks = [], []
            for k in range(shards):
                own = slice(bounds[k], bounds[k + 1])
                used, local = np.unique(asker[own], return_inverse=True)
                if len(used):
                    keys.append(k)
                    blocks.append(pack(h=b.hashes[used], c=narrow(count[used]), w=narrow(local), s=narrow(shard[own])))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(blocks, pa.binary())], ["bucket", "block"])

    return run


def merge_words(shards: int):
    """Job 2: a bucket's words, counted over all blocks, as a block per shard."""

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        got = [unpack(b) for b in group["block"]]
        h, place = np.unique(np.concatenate([g["h"] for g in got]), return_inverse=True)
        count = np.bincount(place, weights=np.concatenate([g["c"] for g in got]).astype(float), minlength=len(h)).astype(np.int64)
        start = np.cumsum([0] + [len(g["h"]) for g in got])
        asks = np.unique(np.concatenate([g["s"].astype(np.int64) * len(h) + place[s + g["w"].astype(np.int64)] for g, s in zip(got, start[:-1], strict=True)]))
        shard, word = asks // len(h), asks % len(h)
        bounds = np.searchsorted(shard, np.arange(shards + 1))
        rows = [(k, pack(h=h[word[a:z]], c=narrow(count[word[a:z]]))) for k, (a, z) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if z > a]
        out = pd.DataFrame(rows, columns=["shard", "block"])
        out["total"], out["kinds"] = 0, 0
        out.loc[0, ["total", "kinds"]] = [int(count.sum()), int((count > 0).sum())]
        return out.astype({"shard": "int32", "total": "int64", "kinds": "int64"})

    return run


def pair_blocks(shards: int, hot: np.ndarray):
    """Job 3: per block and shard the pairs of the block's documents; the
    documents themselves go along to one of the shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for k, b in enumerate(token_blocks(batches)):
            uid = (part << 32) | k  # the same when the task runs again
            n = np.bincount(b.doc, minlength=len(b.ids))
            to, blocks, kind = [uid % shards], [pack(row=b.row + (part << 32), id=b.ids, null=b.null, train=b.train, n=narrow(n))], [2]
            at = shard_of(b.hashes[b.context], b.hashes[b.word], hot, shards)
            order = np.argsort(at.astype(np.uint16) if shards < 1 << 16 else at, kind="stable")
            bounds = np.searchsorted(at[order], np.arange(shards + 1))
            place, marked = np.empty(len(b.hashes), dtype=np.int32), np.zeros(len(b.hashes), dtype=bool)
            for s in range(shards):
                own = order[bounds[s] : bounds[s + 1]]
                if not len(own):
                    continue
                word, context = b.word[own], b.context[own]
                marked[word] = marked[context] = True
                used = np.flatnonzero(marked)
                marked[used] = False
                place[used] = np.arange(len(used))
                step = np.diff(b.doc[own], prepend=0)  # documents come in order
                blocks.append(pack(h=b.hashes[used], w=narrow(place[word]), u=narrow(place[context]), d=narrow(step), train=np.packbits(b.train[b.doc[own]])))
                to.append(s)
                kind.append(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(to, pa.int32()), pa.array(kind, pa.int32()), pa.array([uid] * len(to), pa.int64()), pa.array(blocks, pa.binary())], ["shard", "kind", "uid", "block"]
            )

    return run


def shard_scores(total: int, kinds: int, texts: int, mass: float):
    """A shard's trie, and per block the sums of its documents."""
    start = np.uint64(_hash(START))

    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        kind = group["kind"].to_numpy()
        counted = [unpack(b) for b in group["block"][kind == 0]]
        out = [(int(u), b, True) for u, b in zip(group["uid"][kind == 2], group["block"][kind == 2], strict=True)]
        uids = group["uid"][kind == 1].tolist()
        if uids:
            h = np.concatenate([g["h"] for g in counted])
            c = np.concatenate([g["c"].astype(np.int64) for g in counted])
            order = np.argsort(h)
            h, c = h[order], c[order]
            as_context = np.where(h == start, texts, c)
            n = np.int64(len(h))
            keys, trained, docs = [], [], []
            for block in group["block"][kind == 1]:
                g = unpack(block)
                place = np.searchsorted(h, g["h"])
                keys.append(place[g["u"].astype(np.int64)] * n + place[g["w"].astype(np.int64)])
                trained.append(np.unpackbits(g["train"])[: len(keys[-1])].astype(bool))
                docs.append(np.cumsum(g["d"], dtype=np.int32))
            sizes = [len(k) for k in keys]
            pair, which = numbered(np.concatenate(keys))
            del keys, group
            count = np.bincount(which[np.concatenate(trained)], minlength=len(pair))
            context, word = (pair // n).astype(np.int32), (pair % n).astype(np.int32)
            del pair
            seen = count > 0
            trie = Trie(Trie.build(h, c, as_context, total, kinds, context[seen], word[seen], count[seen], mass))
            del seen, count
            score = np.concatenate([trie.score(context[k : k + 8 * PART], word[k : k + 8 * PART]) for k in range(0, len(context), 8 * PART)])
            base = np.log10(c[word] + 1.0) - np.log10(total + kinds + 1.0)
            known = (c[word] > 0).astype(float)
            at = 0
            for uid, size, doc in zip(uids, sizes, docs, strict=True):
                own = which[at : at + size]
                at += size
                first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                sums = [np.add.reduceat(v[own], first) for v in (score, base, known)]
                out.append((int(uid), pack(d=narrow(doc[first]), s=sums[0], b=sums[1], k=narrow(sums[2].astype(np.int64))), False))
        return pd.DataFrame(out, columns=["uid", "block", "docs"]).astype({"uid": "int64", "docs": "bool"})

    return run


def gather(key, group: pd.DataFrame) -> pd.DataFrame:
    """Job 4: the sums of one block's documents."""
    rows = unpack(group["block"][group["docs"]].iloc[0])
    n = len(rows["id"])
    score, base, known = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64)
    # In one order, so that reruns add up alike.
    for g in sorted((unpack(b) for b in group["block"][~group["docs"]]), key=lambda g: (len(g["d"]), float(g["s"].sum()))):
        score[g["d"]] += g["s"]
        base[g["d"]] += g["b"]
        known[g["d"]] += g["k"]
    ids = pd.Series(rows["id"]).astype("Int64").mask(pd.Series(rows["null"]))
    return pd.DataFrame({"row": rows["row"], "doc_id": ids, "train": rows["train"], "n_tokens": rows["n"].astype(np.int64), "n_known": known, "base_score": base, "score": score})


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def hot_contexts(docs: DataFrame, text: str, size: int, shards: int) -> np.ndarray:
    """Hashes of words over a quarter of a shard's share in a sample of about
    SAMPLE_BYTES; there are at most 4 * shards."""
    every = max(1, size // SAMPLE_BYTES)
    sample = docs.filter(F.pmod(F.xxhash64(text, F.lit(3)), F.lit(every)) == 0)
    w = sample.select(F.explode(words(F.col(text))).alias("w")).groupBy(F.translate("w", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("w")).count()
    w = materialize(w)
    total = w.agg(F.sum("count").alias("n")).first()["n"] or 0
    return np.array(sorted(_hash(r["w"].encode()) for r in w.filter(F.col("count") > total / (4 * shards)).collect()), dtype=np.uint64)


def score_texts(docs: DataFrame, train: Column, text: str = "text", ident: str = "doc_id", mass: float = MASS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of
    every row of ``docs``, learnt from the rows for which ``train`` holds."""
    rows = docs.select(F.col(ident).cast("long").alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__text"), F.coalesce(train, F.lit(False)).alias("__train"))
    facts = rows.agg(F.sum(F.octet_length("__text")).alias("size"), F.sum(F.col("__train").cast("long")).alias("texts")).first()
    size, texts = facts["size"] or 0, facts["texts"] or 0
    shards = max(4, -(-size // SHARD_BYTES))
    hot = hot_contexts(rows, "__text", size, shards)
    counted = rows.mapInArrow(word_counts(shards, hot), "bucket int, block binary")
    merged = materialize(counted.groupBy("bucket").applyInPandas(merge_words(shards), "shard int, block binary, total long, kinds long"))
    sums = merged.agg(F.sum("total").alias("n"), F.sum("kinds").alias("v")).first()
    total, kinds = sums["n"] or 0, sums["v"] or 0
    model = merged.select("shard", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("uid"), "block")
    asked = rows.mapInArrow(pair_blocks(shards, hot), "shard int, kind int, uid long, block binary")
    answers = model.unionAll(asked).groupBy("shard").applyInPandas(shard_scores(total, kinds, texts, mass), "uid long, block binary, docs boolean")
    parts = answers.groupBy("uid").applyInPandas(gather, "row long, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    out = parts.groupBy("row").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("train").alias("train"), *sums)  # a long text has several parts
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def training_rows(ident: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text leaves another remainder than 2 by 7;
    NULL ids are not learnt from."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % 7 != 2
