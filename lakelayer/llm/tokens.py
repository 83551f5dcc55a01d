"""Token-id output: independent zstandard frames with a trailing seek table.

Documents are range-partitioned by (id, text hash, source partition), so many
rows of one id, or copies of one row, are split; each partition encodes its
documents in ascending id order and writes one file.  A file is a run of

* data frames: independent zstandard frames of about ``FRAME_IDS`` token ids
  each, little-endian, 2 bytes an id where the vocabulary allows, else 4; a
  document may begin in one frame and end in a later one;
* one skippable frame with the documents' index (zstandard): id width, then per
  document its id, whether it is NULL, and its first token in the file;
* the seek table, a skippable frame in the public seekable format: per data
  frame its compressed size, its size and the low 32 bits of the XXH64 of its
  content; then the number of frames, a descriptor byte and the magic number.

A reader takes the seek table from the end of the file, decompresses only the
frames that hold the documents asked for, and checks their checksums.

Files go to the shared folder through ``pyarrow.fs`` (local, HDFS, S3, GCS
paths), each under a name of its own attempt and moved there when complete; the
manifest lists those of the attempts that ended well, so a lost executor leaves
at most a file that nobody reads.

Encoding: a text is cut before single spaces between other characters, where byte-level
BPE of this kind always cuts as well; each different word is encoded once and
remembered, up to ``MEMO`` words, over the tasks of a worker.  Memory: one
batch of texts, their ids, the memo, one frame.

Defined results: NULL text is empty and holds the end id only; NULL ids come
first; rows of equal ids stand in the order of the text's hash; repeated rows are
written again; an empty table gives no file and an empty result.  Strings of
special tokens are encoded as the library does by default, as one id.
"""

from __future__ import annotations

import gc
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import materialize
from lakelayer.session import ensure_checkpoint_dir

FRAME_IDS = 1 << 17
BATCH_BYTES = 8_000_000  # of texts encoded together, or one text
MEMO = 1_200_000  # words, and pieces, that a worker remembers
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1  # fixed values of the public seekable format
INDEX_FRAME = 0x184D2A50  # another skippable frame: the documents' index
TABLE_FRAME = SKIPPABLE
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte-level BPE writes a byte as a character: itself if printed, else 256 and on.
BYTE_CHARS = {b: chr(b) for b in PRINTED} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in PRINTED)}
MANIFEST = "part int, file string, n_docs long, n_ids long"


class Words(dict):
    """Word -> the ids' bytes; those asked for in vain are listed."""

    def __init__(self, known: dict[str, bytes] | None = None):
        super().__init__(known or {})
        self.asked: list[str] = []

    def __missing__(self, word: str) -> None:
        self.asked.append(word)


class Encoder:
    """Texts to bytes of little-endian ids; bounded memos of words and pieces.

    Its state is built on first use, so a broadcast one is kept by a reused
    Python worker from task to task."""

    def __init__(self, path: str):
        self.path, self.tokenizer = path, None

    def load(self) -> int:
        """Bytes of an id."""
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
            self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
            self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
            self.words = Words()  # words with a space in front
            self.heads: dict[str, bytes] = {}  # first words, without a space
            self.pieces: dict[str, bytes] = {}  # a piece as the pre-tokenizer maps it
            self.plain = self.tokenizer.normalizer is None
            self.marks = {m: self.direct(m) for m in ",.;:!?"}
            self.space = BYTE_CHARS[32]
        return self.width

    def packed(self, ids: list[int]) -> bytes:
        return array("H" if self.width == 2 else "I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, f"<u{self.width}").tobytes()

    def direct(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids) if text else b""

    def head(self, word: str) -> bytes:
        """The ids of a text's first word."""
        ids = self.heads.get(word)
        if ids is None:
            if len(self.heads) >= MEMO // 16:
                self.heads.clear()
            ids = self.heads[word] = self.direct(word)
        return ids

    def learn(self, words: list[str]) -> None:
        """The ids of each word behind a space.  Letters are one piece; a mark behind a
        letter is a piece of its own, so such a word is its letters' ids and the mark's."""
        known, tokenize, packed, space = self.words, self.tokenizer.model.tokenize, self.packed, self.space
        if not self.plain:
            return self.learn_whole(words)
        stems = {w: w[:-1] for w in words if w[-1] in self.marks and w[:-1].isalpha() and w[-2] < "\u0250"}
        bare = {w for w in words if w not in stems}.union(w for w in stems.values() if w not in known)
        mixed, kind = [], ("H" if self.width == 2 else "I") * (sys.byteorder == "little")
        for w in bare:
            if not w.isalpha() or not w.isascii() and max(w) >= "\u0250":
                mixed.append(w)
                continue
            piece = w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_CHARS)
            ids = [t.id for t in tokenize(space + piece)]
            known[w] = array(kind, ids).tobytes() if kind else packed(ids)
        self.learn_whole(mixed)
        for w, stem in stems.items():
            known[w] = known[stem] + self.marks[w[-1]]

    def learn_whole(self, words: list[str]) -> None:
        """The ids of each word behind a space: all go through the pre-tokenizer at
        once, which cuts before every space between other characters; each
        different piece goes through the model once."""
        odd = [w for w in words if any(t in w for t in self.special)] if self.plain else words
        self.words.update((w, self.direct(" " + w)) for w in odd)
        words = list(set(words).difference(odd)) if odd else words
        pieces, tokenize = self.pieces, self.tokenizer.model.tokenize
        found = iter(self.tokenizer.pre_tokenizer.pre_tokenize_str(" " + " ".join(words)) if words else ())
        end = 0
        for w in words:
            end += 1 + len(w)
            own, at = [], 0
            while at < end:
                piece, (_, at) = next(found)
                ids = pieces.get(piece)
                if ids is None:
                    ids = pieces[piece] = self.packed([t.id for t in tokenize(piece)])
                own.append(ids)
            self.words[w] = own[0] if len(own) == 1 else b"".join(own)

    def apart(self, parts: list[str]) -> bytes:
        """A text with spaces at its ends or beside other white space, by its parts
        between spaces: cut only before spaces that stand between other characters."""
        units, last = [], parts[0]
        for p in parts[1:]:
            if last and p and not last[-1].isspace() and not p[0].isspace():
                units.append(last)
                last = " " + p
            else:
                last += " " + p
        return b"".join(map(self.direct, [*units, last]))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, as the tokenizer encodes it whole.  Each different
        part between spaces is looked up once, then the ids are gathered."""
        self.load()
        parts = pc.split_pattern(texts, " ")
        at = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        place, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        at -= at[0]
        known = self.known(words)
        odd = np.array([ids is None for ids in known], bool)
        known = [ids or b"" for ids in known]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.width
        flat, begins = np.frombuffer(b"".join(known), dtype=f"<u{self.width}"), np.cumsum(sizes) - sizes
        sizes, begins, first = sizes[place], begins[place], at[:-1]
        sizes[first] = 0  # a first part has no space in front
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0  # ids of a batch: 32 bits hold their places
        ids = flat[np.arange(total, dtype=np.int32) - np.repeat((ends - sizes - begins).astype(np.int32), sizes)]
        apart = np.concatenate([[0], np.cumsum(odd[place])])
        ends = np.concatenate([[0], ends])
        out = []
        for i, text in enumerate(texts):
            a, b = at[i], at[i + 1]
            head = words[place[a]]
            if apart[b] > apart[a + 1] or head[-1:].isspace() or not head:
                out.append(self.apart(text.as_py().split(" ")))
            else:
                out.append(self.head(head) + ids[ends[a] : ends[b]].tobytes())
        return out

    def known(self, words: list[str]) -> list[bytes | None]:
        """The ids of different words, each behind a space; None for one that is empty or
        has white space at an end."""
        found = list(map(self.words.__getitem__, words))
        unseen, self.words.asked = self.words.asked, []
        collects = gc.isenabled()
        gc.disable()  # no cycles arise here, and each collection would walk the memo
        if len(self.pieces) > MEMO // 4:
            self.pieces.clear()
        if len(self.words) + len(unseen) > MEMO:  # what these texts use stays
            self.words = Words({w: ids for w, ids in zip(words, found, strict=True) if ids is not None})
        new = [w for w in unseen if w and not w[0].isspace() and not w[-1].isspace()]
        for k in range(0, len(new), 50_000):
            self.learn(new[k : k + 50_000])
        if collects:
            gc.enable()
        return [self.words.get(w) if ids is None else ids for w, ids in zip(words, found, strict=True)] if new else found


class FileWriter:
    """Writes one file of frames, documents one after another."""

    def __init__(self, sink, width: int, frame_ids: int, level: int):
        import zstandard

        self.sink, self.width, self.limit = sink, width, frame_ids * width
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.open: list[bytes] = []
        self.held = self.n_ids = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, bool, int]] = []

    def frame(self, raw: bytes) -> None:
        import xxhash

        packed = self.zstd.compress(raw)
        self.sink.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def add(self, ident: int | None, ids: bytes) -> None:
        self.docs.append((ident or 0, ident is None, self.n_ids))
        self.n_ids += len(ids) // self.width
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= self.limit:
            raw = b"".join(self.open)
            whole = len(raw) - len(raw) % self.limit
            for k in range(0, whole, self.limit):
                self.frame(raw[k : k + self.limit])
            self.open, self.held = [raw[whole:]], len(raw) - whole

    def close(self) -> None:
        if self.held:
            self.frame(b"".join(self.open))
        ids = np.array([d[0] for d in self.docs], dtype="<i8")
        nulls = np.array([d[1] for d in self.docs], dtype="u1")
        starts = np.array([*(d[2] for d in self.docs), self.n_ids], dtype="<u8")
        index = self.zstd.compress(struct.pack("<BQ", self.width, len(ids)) + ids.tobytes() + nulls.tobytes() + starts.tobytes())
        self.sink.write(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, SEEK_MAGIC)
        self.sink.write(struct.pack("<II", TABLE_FRAME, len(table)) + table)


class FileReader:
    """Random access to a file of frames; ``decompressed`` counts the frames read."""

    def __init__(self, source):
        import zstandard

        self.source, self.decompressed = source, 0
        size = source.size()
        n, descriptor, magic = struct.unpack("<IBI", self.at(size - 9, 9))
        if magic != SEEK_MAGIC or not descriptor & 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        table = size - 9 - 12 * n
        self.frames = np.frombuffer(self.at(table, 12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.raw_ends = np.cumsum(self.frames[:, 1])
        kind, length = struct.unpack("<II", self.at(int(self.offsets[-1]), 8))
        if kind != INDEX_FRAME:
            raise ValueError("no document index behind the data frames")
        index = zstandard.ZstdDecompressor().decompress(self.at(int(self.offsets[-1]) + 8, length))
        self.width, d = struct.unpack_from("<BQ", index)
        self.ids = np.frombuffer(index, "<i8", d, 9)
        self.nulls = np.frombuffer(index, "u1", d, 9 + 8 * d).astype(bool)
        self.starts = np.frombuffer(index, "<u8", d + 1, 9 + 9 * d).astype(np.int64)
        self.zstd, self.held = zstandard.ZstdDecompressor(), (-1, b"")

    def at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(length)

    def frame(self, k: int) -> bytes:
        import xxhash

        if self.held[0] != k:
            raw = self.zstd.decompress(self.at(int(self.offsets[k]), int(self.frames[k, 0])), max_output_size=int(self.frames[k, 1]))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"frame {k}: checksum differs")
            self.held = (k, raw)
            self.decompressed += 1
        return self.held[1]

    def document(self, k: int) -> np.ndarray:
        """Token ids of the file's k-th document."""
        lo, hi = int(self.starts[k]) * self.width, int(self.starts[k + 1]) * self.width
        f, parts = int(np.searchsorted(self.raw_ends, lo, side="right")), []
        while lo < hi:
            begin = int(self.raw_ends[f] - self.frames[f, 1])
            end = min(hi, int(self.raw_ends[f]))
            parts.append(self.frame(f)[lo - begin : end - begin])
            lo, f = end, f + 1
        return np.frombuffer(b"".join(parts), dtype=f"<u{self.width}")

    def find(self, ident: int | None) -> range:
        """Positions of the documents of an id."""
        if ident is None:
            return range(int(self.nulls.sum()))
        first = int(self.nulls.sum())
        a, b = (first + int(np.searchsorted(self.ids[first:], ident, side=s)) for s in ("left", "right"))
        return range(a, b)


def open_folder(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write_files(docs: DataFrame, tokenizer: str, text: str = "text", ident: str = "doc_id", folder: str | None = None, end_id: int = 0, frame_ids: int = FRAME_IDS, level: int = 1) -> DataFrame:
    """Encodes the texts of ``docs`` into files in ``folder`` (default: a new one in
    the cluster's shared folder); ``tokenizer`` is the path of a file of the
    tokenizers library on every worker.  Returns the manifest: part (the order
    of the files), file, n_docs, n_ids, start (ids of all files before)."""
    spark = docs.sparkSession
    folder = folder or f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-tokens-{uuid.uuid4().hex}"
    slim = docs.select(F.col(ident).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    slim = slim.withColumns({"h": F.xxhash64("text"), "p": F.spark_partition_id()})
    order = [F.asc_nulls_first("id"), "h", "p"]
    parts = max(1, slim.rdd.getNumPartitions())
    ranged = slim.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")

    shared = spark.sparkContext.broadcast(Encoder(tokenizer))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy())])
            at = 0
            while at < len(ids):
                if writer is None:
                    encoder, (store, root) = shared.value, open_folder(folder)
                    store.create_dir(root, recursive=True)
                    part = TaskContext.get().partitionId()
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
                    sink = store.open_output_stream(f"{root}/.{name}", compression=None)
                    writer = FileWriter(sink, encoder.load(), frame_ids, level)
                    end = end_id.to_bytes(encoder.width, "little")
                end_at = max(at + 1, int(np.searchsorted(sizes, sizes[at] + BATCH_BYTES, side="right")) - 1)
                for i, raw in zip(ids[at:end_at], encoder.encode(texts[at:end_at]), strict=True):
                    writer.add(i, raw + end)
                at = end_at
        if writer is not None:
            writer.close()
            sink.close()
            store.move(f"{root}/.{name}", f"{root}/{name}")
            yield pa.RecordBatch.from_pylist([{"part": part, "file": f"{folder}/{name}", "n_docs": len(writer.docs), "n_ids": writer.n_ids}], schema=pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    files = materialize(ranged.mapInArrow(encode, MANIFEST))
    # One row per file.
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_files(manifest: DataFrame) -> DataFrame:
    """Reads the files of a manifest: per document doc_id, start (ids of all documents
    before it), n_tokens (with the end id), ids_crc32."""
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = open_folder(row["file"])
                with store.open_input_file(path) as source:
                    reader = FileReader(source)
                    for k in range(0, len(reader.ids), 10_000):
                        some = range(k, min(k + 10_000, len(reader.ids)))
                        starts = reader.starts[k : some.stop + 1]
                        crcs = [zlib.crc32(reader.document(d).astype("<u4").tobytes()) for d in some]
                        ids = pa.array(reader.ids[k : some.stop], mask=reader.nulls[k : some.stop])
                        yield pa.RecordBatch.from_arrays([ids, pa.array(starts[:-1] + row["start"]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())], schema=out)

    files = materialize(manifest)
    return files.repartition(max(1, files.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(manifest: DataFrame, wanted: DataFrame, ident: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the token ids of the documents of the ids in ``wanted``.  The files'
    own indexes are joined with the ids, and each file decompresses only the
    frames that hold the documents found.  Ids asked for twice are returned once."""
    asked = wanted.select(F.col(ident).cast("long").alias("wanted")).distinct()
    held = pa.schema([("file", pa.string()), ("id", pa.int64()), ("at", pa.int64())])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file in (f for batch in batches for f in batch.column(0).to_pylist()):
            store, path = open_folder(file)
            with store.open_input_file(path) as source:
                reader = FileReader(source)
            n = len(reader.ids)
            yield pa.RecordBatch.from_arrays([pa.array([file] * n, pa.string()), pa.array(reader.ids, mask=reader.nulls), pa.array(np.arange(n))], schema=held)

    def fetch(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        store, path = open_folder(key[0].as_py())
        with store.open_input_file(path) as source:
            reader = FileReader(source)
            rows = [(i, reader.document(k).tolist()) for k, i in sorted(zip(table.column("at").to_pylist(), table.column("id").to_pylist(), strict=True))]
        return pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "ids": pa.array([r[1] for r in rows], pa.list_(pa.int64()))})

    files = materialize(manifest.select("file"))
    where = files.repartition(max(1, files.count())).mapInArrow(index, "file string, id long, at long")
    found = where.join(asked, F.col("id").eqNullSafe(F.col("wanted")), "left_semi")
    return found.groupBy("file").applyInArrow(fetch, "doc_id long, ids array<long>")
