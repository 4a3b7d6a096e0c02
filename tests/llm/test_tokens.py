"""Token files, BPE table: against the tokenizers library on whole texts, round trips, edges."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from laborlens.llm import bpe_table, common, token_files
from laborlens.llm.queries import tokenizer_file
from laborlens.llm.wordcodec import WordCodec
from llm_data import edges, empty, generated, texts_of


def library(name):
    t = Tokenizer.from_file(tokenizer_file(name))
    t.no_truncation()
    t.no_padding()
    return t


ALPHABET = ["a", "b", "B", " ", "  ", "\n", "\t", "\xa0", chr(0x3000), "'s", "'", "9", "!", "é", "É", "<|endoftext|>", "\x1c",
            chr(0x301), "ß", "\x85", "日本", "İ", "Σ", "<|startoftext|>", ".", "x²", "½", "\x00"]


def random_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randrange(14))) for _ in range(n)]


def test_word_codec_equals_library():
    codec, lib = WordCodec(tokenizer_file("word_bpe_49k.json")), library("word_bpe_49k.json")
    texts = random_texts(4000, 1)
    for t, got in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(got, codec.dtype).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_word_codec_with_full_tables(monkeypatch):
    from laborlens.llm import wordcodec
    monkeypatch.setattr(wordcodec, "TABLE_LIMIT", 3)
    codec, lib = WordCodec(tokenizer_file("word_bpe_49k.json")), library("word_bpe_49k.json")
    texts = ["some words, and more words here!", "other words: 12 more"]
    assert [np.frombuffer(x, codec.dtype).tolist() for x in codec.encode(texts)] == [
        lib.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(codec.words) <= 3 and len(codec.pieces) <= 3


def test_units_are_independent():
    lib = library("byte_bpe_50k.json")
    for t in random_texts(4000, 2):
        parts = bpe_table.units(t)
        assert b"".join(parts) == t.encode()
        assert [i for p in parts for i in lib.encode(p.decode(), add_special_tokens=False).ids] == lib.encode(
            t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("table", [edges, generated, empty])
def test_token_files(spark, table):
    df = table(spark)
    path = common.shared(spark, "test-tokens")
    token_files.write_token_files(df, path, tokenizer_file("word_bpe_49k.json"), end_id=1, files=3)
    got = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    lib, at = library("word_bpe_49k.json"), 0
    want = texts_of(df)
    assert [r.doc_id for r in got] == [i for i, _ in want]
    whole = token_files.TokenFiles(spark, path)
    for k, (r, (_, t)) in enumerate(zip(got, want, strict=True)):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        assert (r.start, r.n_tokens, zlib.crc32(r.ids)) == (at, len(ids), zlib.crc32(ids.tobytes()))
        assert whole[k].tolist() == ids.tolist()
        at += len(ids)
    assert (whole.n_docs, whole.n_tokens) == (len(want), at)
    assert len(whole.tokens(at // 3, at // 2)) == at // 2 - at // 3


@pytest.mark.parametrize("table", [edges, generated, empty])
def test_bpe_table(spark, table, monkeypatch):
    df = table(spark)
    got = bpe_table.encode_decode(df, tokenizer_file("byte_bpe_50k.json")).collect()
    lib = library("byte_bpe_50k.json")
    want = []
    for i, t in texts_of(df):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), ",".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False)))
        assert want[-1][3] == (t or "")
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_small_chunks_give_the_same(monkeypatch):
    """Chunk bounds don't show: the splitter with tiny chunks still covers every document."""
    import pyarrow as pa

    class Context:
        @staticmethod
        def get():
            return type("T", (), {"partitionId": staticmethod(lambda: 2)})
    monkeypatch.setattr(bpe_table, "TaskContext", Context)
    monkeypatch.setattr(bpe_table, "CHUNK_BYTES", 10)
    monkeypatch.setattr(bpe_table, "DOCS_PER_BLOCK", 2)
    docs = ["ab cd", "cd", "", "ef ab", "gh"]
    batch = pa.RecordBatch.from_pydict({"d": pa.array(range(5), pa.int64()), "t": docs})
    rows = [r for b in bpe_table._splitter(3)([batch]) for r in b.to_pylist()]
    assert len({r["chunk"] for r in rows}) > 1
    names, back = {}, {}
    for r in rows:
        if r["part"] != bpe_table.DOCUMENTS:
            at, lens, raw = bpe_table._unpack(r["blob"])
            ends = np.cumsum(lens)
            for i, e, n in zip(at.tolist(), ends.tolist(), lens.tolist(), strict=True):
                names[r["chunk"], i] = raw.tobytes()[e - n:e]
    for r in rows:
        if r["part"] == bpe_table.DOCUMENTS:
            ids, _, n, flat = bpe_table._unpack(r["blob"])
            ends = np.cumsum(n)
            for d, e, m in zip(ids.tolist(), ends.tolist(), n.tolist(), strict=True):
                back[d] = b"".join(names[r["chunk"], i] for i in flat[e - m:e].tolist()).decode()
    assert back == dict(enumerate(docs))
