import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lakelayer.llm import tokens
from lakelayer.llm.queries import op13_token_output

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def brute(library, rows):
    """(doc_id, start, n_tokens, crc) of rows in their order."""
    out, start = [], 0
    for ident, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((ident, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_brute_force(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, op13_token_output(spark, sf).collect()), key=lambda r: r[1])
    assert got == brute(library, docs)


def test_encoder_equals_library(library):
    encoder, rng = tokens.Encoder(PATH), random.Random(1)
    texts = ["".join(rng.choice(" \n\t aAb1.,!'sé́ \x1c 　中ऀ") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["don't we'll I'm", "x,y, z!! 12a a12", "a <|endoftext|> b<|endoftext|>, c", "é, ñ! ", "word " * 50_000]
    for t, raw in zip(texts, encoder.encode(pa.array(texts)), strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_memo_is_bounded(library, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 50)
    encoder = tokens.Encoder(PATH)
    for k in range(20):
        text = " ".join(f"w{k}x{j}" for j in range(30))
        assert np.frombuffer(encoder.encode(pa.array([text]))[0], "<u2").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.words) <= 80


def test_messy_rows_round_trip(spark, messy, clash, no_docs, library):
    for df in (messy, clash):
        got = sorted(map(tuple, tokens.read_files(tokens.write_files(df, PATH, frame_ids=64)).collect()), key=lambda r: r[1])
        assert [r[0] for r in got] == sorted((r["doc_id"] for r in df.collect()), key=lambda i: (i is not None, i or 0))
        ends = [r[1] + r[2] for r in got]
        assert [r[1] for r in got] == [0, *ends[:-1]]
        assert sorted((r[0] or -1, r[2], r[3]) for r in got) == sorted((i or -1, n, c) for i, _, n, c in brute(library, [(r["doc_id"], r["text"]) for r in messy.collect()]))
    assert tokens.read_files(tokens.write_files(no_docs, PATH)).count() == 0


def test_only_requested_frames_are_read(spark, library, tmp_path):
    texts = [(k, f"document {k} " + "some words " * 50) for k in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    manifest = tokens.write_files(df, PATH, folder=str(tmp_path), frame_ids=1000)
    file = manifest.collect()[0]["file"]
    store, path = tokens.open_folder(file)
    with store.open_input_file(path) as source:
        reader = tokens.FileReader(source)
        assert len(reader.frames) > 10 and (reader.frames[:-1, 1] == 2000).all()
        for k in (7, 399):
            (at,) = reader.find(k)
            assert reader.document(at).tolist() == [*library.encode(texts[k][1], add_special_tokens=False).ids, 0]
        assert reader.decompressed <= 4 and list(reader.find(1000)) == []
    wanted = spark.createDataFrame([(3,), (250,), (250,), (9999,)], "doc_id long")
    got = {r["doc_id"]: r["ids"] for r in tokens.read_documents(manifest, wanted).collect()}
    assert got == {k: [*library.encode(texts[k][1], add_special_tokens=False).ids, 0] for k in (3, 250)}


def test_files_follow_the_seekable_format_and_fail_when_damaged(spark, tmp_path):
    import struct

    import zstandard

    df = spark.createDataFrame([(k, f"text {k} " * 30) for k in range(50)], "doc_id long, text string").coalesce(1)
    file = tokens.write_files(df, PATH, folder=str(tmp_path), frame_ids=500).collect()[0]["file"]
    raw = open(file, "rb").read()  # noqa: SIM115
    n, descriptor, magic = struct.unpack("<IBI", raw[-9:])
    assert (descriptor, magic) == (0x80, 0x8F92EAB1)
    kind, length = struct.unpack("<II", raw[-17 - 12 * n : -9 - 12 * n])
    assert kind == 0x184D2A5E and length == 12 * n + 9
    # Any zstandard reader takes the data frames and skips the others.
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(whole) == sum(struct.unpack_from("<I", raw, len(raw) - 9 - 12 * (n - k) + 4)[0] for k in range(n))
    table = len(raw) - 9 - 12 * n
    damaged = bytearray(raw)
    damaged[table + 8] ^= 1  # the first frame's checksum
    (tmp_path / "damaged.ids.zst").write_bytes(damaged)
    store, path = tokens.open_folder(str(tmp_path / "damaged.ids.zst"))
    with store.open_input_file(path) as source, pytest.raises(ValueError, match="checksum"):
        tokens.FileReader(source).document(0)


def test_null_ids_and_copies_are_split(spark, library):
    df = spark.range(4000).selectExpr("if(id % 3 = 0, null, id % 7) doc_id", "'the same text' text").repartition(8)
    manifest = tokens.write_files(df, PATH)
    assert manifest.agg({"n_docs": "max"}).first()[0] < 2000
    assert tokens.read_files(manifest).agg({"start": "max"}).first()[0] == 3999 * len([*library.encode("the same text").ids, 0])
