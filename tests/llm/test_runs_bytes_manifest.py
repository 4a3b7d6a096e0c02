"""Periodic runs, byte-level BPE and the Merkle manifest against plain versions of their definitions."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from laborlens.llm import byte_bpe, merkle, periodic_runs
from laborlens.llm.queries import FIELDS, QUERIES, tokenizer_file, with_repeats
from llm_data import SF, edges, empty, generated, texts_of

VOCAB = "byte_bpe_50k.tiktoken"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def asked(rows):
    """Rows of a result, null ids first, then by all values."""
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, str(r[1:])))


# ---------------------------------------------------------------- periodic runs

def plain_runs(words, min_length=24, times=3):
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - a + q
            inside = words[a:a + length]
            if length >= max(min_length, times * q) and all(inside[d:] != inside[:-d] for d in range(1, q)):
                out.append((a, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_op11(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and crc(doc_id) % 10 == 0 and n:
        g = crc(doc_id) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    stay = [w for i, w in enumerate(words) if not any(s + q <= i < s + ln for s, ln, q in runs)]
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{ln},{q}\n" for s, ln, q in runs)), sha(b" ".join(stay)))


@pytest.mark.parametrize("min_length,times", [(24, 3), (6, 3), (9, 3), (10, 5), (40, 4)])
def test_runs_equal_brute_force_on_random_sequences(min_length, times):
    r = random.Random(min_length * 10 + times)
    for case in range(150):
        kind, words = case % 5, []
        while len(words) < r.randint(0, 260):
            if kind == 0:
                words += [r.choice("ab") for _ in range(r.randint(1, 30))]
            elif kind == 1:
                words += [r.choice("abcd") for _ in range(r.randint(1, 9))] * r.randint(1, 9)
            elif kind == 2:
                words += ["a"] * r.randint(1, 60) + [r.choice("abc")]
            elif kind == 3:  # runs of runs
                inner = [r.choice("ab") for _ in range(r.randint(1, 4))] * r.randint(1, 8) + [r.choice("abc")]
                words += inner * r.randint(1, 5)
            else:
                words += [str(r.randint(0, 400)) for _ in range(r.randint(1, 40))] * r.choice([1, 1, 3, 4])
        number = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        assert periodic_runs.runs_of(ids, min_length, times) == plain_runs(words, min_length, times), (case, words)


def test_periods_whose_every_gram_repeats_inside_them():
    """Two long passages in an order that puts each k-gram of the shortest kind into a period twice."""
    r = random.Random(3)
    a, b = [[str(r.randint(0, 9)) for _ in range(20)] for _ in range(2)]
    period = sum(([a, b][x] for x in (0, 0, 0, 1, 1, 1, 0, 1)), [])
    words = ["x"] + period * 4 + ["y"]
    ids = np.unique(words, return_inverse=True)[1].astype(np.int64)
    found = periodic_runs.runs_of(ids)
    assert found == plain_runs(words)
    assert (1, 4 * len(period), len(period)) in found


def test_lag_classes_cover_every_lag_and_keep_the_bound():
    for min_length, times in ((24, 3), (6, 3), (50, 4)):
        at = 1
        for lo, hi, k, partners in periodic_runs.lag_classes(5000, min_length, times):
            assert lo == at and 1 <= partners <= periodic_runs.PARTNERS
            assert all(k <= periodic_runs.overlap(q, min_length, times) for q in (lo, hi)) and k >= hi
            at = hi + 1
        assert at == 5001


def test_one_word_many_times_is_one_run():
    ids = np.zeros(200_000, np.int64)
    assert periodic_runs.runs_of(ids) == [(0, 200_000, 1)]


def test_op11_against_brute_force(spark):
    docs = generated(spark)
    want = asked(plain_op11(i, t) for i, t in texts_of(docs))
    got = asked(QUERIES["op11_periodic_runs"](spark, SF).collect())
    assert got == want
    assert sum(r[1] for r in got) > 5


def test_periodic_runs_edges(spark):
    for df in (edges(spark), edges(spark).repartition(7), empty(spark)):
        rows = periodic_runs.periodic_runs(df)
        assert rows.columns == ["row", "n_words", "runs", "collapsed"]
        got = rows.select("row.doc_id", "row.`row`", "n_words", "runs", "collapsed").collect()
        texts = texts_of(df)
        assert len(got) == len(texts)
        want = []
        for i, t in texts:
            w = (t or "").encode().split()
            want.append((i, len(w), [tuple(x) for x in plain_runs(w)] if len(w) < 2000 else []))
        assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_words, [tuple(x) for x in r.runs])) for r in got)
    edited = with_repeats(edges(spark))
    assert edited.count() == edges(spark).count()
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(empty(spark), times=2)


# ---------------------------------------------------------------- byte-level BPE

@pytest.fixture(scope="module")
def library():
    import base64

    import public_tokenizers as p
    import tiktoken
    with open(p.path(VOCAB), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ours(texts):
    vocab = byte_bpe.vocabulary(tokenizer_file(VOCAB))
    got = byte_bpe.Encoded([t.encode() for t in texts], vocab)
    cut = np.concatenate([[0], np.cumsum(got.counts)]).tolist()
    out = [(got.ids[a:b].tolist(), got.offsets[a:b].tolist()) for a, b in zip(cut, cut[1:], strict=False)]
    assert got.decimals(vocab) == [" ".join(map(str, ids)) for ids, _ in out]
    return out


def test_bytes_equal_the_library_on_crafted_and_random_texts(library):
    r = random.Random(11)
    bits = ["'s", "'ll", "'LL", "'re", "'r", "'v", "'", "''", " '", "\n'", "a", "don", "Z", "é", "日本", "ß", "7", "²", "Ⅷ", "!", "...",
            " ", "  ", "\n", "\t", "\xa0", " ", "\x85", "\x1c", "​", "😀", "́", "<|endoftext|>", "m", "t", "e", "l"]
    texts = ["", " ", "'", "'s", "s's's", "\n\n\n", " \n x", "a" * 3000, "ab" * 900 + "  ", "é" * 500, "\U0010ffff x"]
    texts += ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    for text, (ids, offsets) in zip(texts, ours(texts), strict=True):
        assert ids == library.encode_ordinary(text), repr(text)
        pieces = [library.decode_single_token_bytes(i) for i in ids]
        assert offsets == np.concatenate([[0], np.cumsum([len(p) for p in pieces])])[:-1].astype(int).tolist()


def test_every_code_point_has_the_librarys_class(library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}'ll {c}1{c}" for c in points]
    wrong = [t for t, (ids, _) in zip(texts, ours(texts), strict=True) if ids != library.encode_ordinary(t)]
    assert not wrong, wrong[:20]


def test_scan_states_do_not_depend_on_block_borders():
    scan = byte_bpe.Scanner()
    r = random.Random(5)
    text = "".join(r.choice("a 1'slre!\n") for _ in range(9000))
    whole = scan.token_starts(text.encode(), np.array([0]))
    states, at = byte_bpe.EDGE, []
    for i, c in enumerate(text):  # the same machine, one character after the other
        cls = int(byte_bpe.class_table()[ord(c)])
        if c == "'":
            after = text[i + 1:i + 3]
            cls = byte_bpe.SHORT if after[:1] in tuple("stmd") and after else byte_bpe.LONG if after in ("re", "ve", "ll") else cls
        white = cls in (byte_bpe.BLANK, byte_bpe.WHITE)
        if byte_bpe._starts_token(states, cls) or (white and i + 1 < len(text) and text[i + 1] not in " \n"):
            at.append(i)
        states = byte_bpe._next_state(states, cls)
    assert whole.tolist() == at


def test_op12_against_the_library(spark, library):
    got = asked(QUERIES["op12_byte_bpe"](spark, SF).collect())
    want = []
    for i, t in texts_of(generated(spark)):
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t or "")))
    assert got == asked(want)


def test_byte_bpe_edges(spark, library):
    vocab = tokenizer_file(VOCAB)
    for df in (edges(spark), edges(spark).repartition(6), empty(spark)):
        rows = byte_bpe.decode(byte_bpe.encode(df, vocab), vocab)
        assert rows.columns == ["row", "ids", "offsets", "decoded"]
        got = sorted((str(r.doc_id), bytes(r.decoded).decode(), r.ids) for r in
                     rows.select("row.doc_id", "row.`row`", "ids", "decoded").collect())
        want = sorted((str(i), t or "", library.encode_ordinary(t or "")) for i, t in texts_of(df))
        assert got == want
        both = byte_bpe.encode_decode(df, vocab).select("row.doc_id", "row.`row`", "n_tokens", "ids", "decoded").collect()
        assert sorted((str(r.doc_id), bytes(r.decoded).decode(), list(map(int, r.ids.split()))) for r in both) == want
        assert all(r.n_tokens == len(r.ids.split()) for r in both)


def test_slice_cache_may_be_emptied():
    cache = byte_bpe.Slices(byte_bpe.vocabulary(tokenizer_file(VOCAB)).ranks)
    old, byte_bpe.CACHE_IDS = byte_bpe.CACHE_IDS, 3
    pieces = [b" tokenization", b"xyzzyq", b" tokenization"]
    try:
        for _ in range(3):
            entries = cache.entries(pieces)
            assert cache.ids(entries).tolist() == sum((byte_bpe.merge_pairs(p, cache.ranks) for p in pieces), [])
            assert len(cache) == 2
    finally:
        byte_bpe.CACHE_IDS = old


# ---------------------------------------------------------------- Merkle manifest

def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(leaves, fanout):
    """(top, sibling digests (left, right) of each leaf level by level)"""
    places, proofs, nodes = list(range(len(leaves))), [[] for _ in leaves], list(leaves)
    while len(nodes) > 1:
        for i, p in enumerate(places):
            a = p - p % fanout
            proofs[i].append(("".join(nodes[a:p]), "".join(nodes[p + 1:a + fanout])))
            places[i] = p // fanout
        nodes = [sha("".join(nodes[a:a + fanout])) for a in range(0, len(nodes), fanout)]
    return nodes[0], proofs


def plain_manifest(rows, fanout=2):
    groups = defaultdict(list)
    for r in rows:
        claimed = r[:3] + (r[3] if r[3] is None or r[0] is None or crc(r[0]) % 7 else r[3] + 1,) + r[4:]
        groups[r[2]].append((r[0] is not None, r[0] or 0, sha("".join(map(field, r))), sha("".join(map(field, claimed))), r[0]))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: plain_tree([x[2] for x in sorted(groups[k])], fanout) for k in keys}
    root, above = plain_tree([trees[k][0] for k in keys], fanout) if keys else (None, [])
    out = []
    for k, up in zip(keys, above, strict=True):
        for (_, _, leaf, claimed, doc_id), proof in zip(sorted(groups[k]), trees[k][1], strict=True):
            at = claimed
            for left, right in proof + up:
                at = sha(left + at + right)
            out.append((doc_id, leaf, trees[k][0], root, sha("".join(a + b for a, b in proof + up)), at, at == root))
    return out


def manifest_rows(spark, docs, fanout=2):
    claimed = merkle.leaf_digest(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, claimed)
    built = merkle.build_manifest(docs, FIELDS, "lang", "doc_id", [F.col("doc_id"), tampered.alias("claimed")], fanout)
    rows = merkle.verified_proofs(spark, built, F.coalesce("carry.claimed", "leaf"))
    return built, rows.select("carry.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("p"),
                              "folded_root", "verified").collect()


def test_op13_against_a_plain_tree(spark):
    rows = [tuple(r) for r in generated(spark).select(*FIELDS).collect()]
    got = asked(QUERIES["op13_merkle_manifest"](spark, SF).collect())
    assert got == asked(plain_manifest(rows))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("fanout", [2, 3, 17])
def test_manifest_with_several_bands_nulls_ties_and_repeats(spark, fanout):
    rows = [(None if i % 50 == 0 else i // 2, "s" if i % 3 else None, [None, "b", "", "é", "a"][min(4, i % 40)],
             None if i % 11 == 0 else i, None if i % 13 == 0 else f"text {i % 7}") for i in range(1900)]
    rows += [(5, "s", "a", 1, "same")] * 9 + [(7, "s", "only", 1, "lone")]
    old, merkle.SPAN = merkle.SPAN, 20  # several bands, one level each for 17
    try:
        docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
        for c in ("g", "n", "lo", "hi", "digest", "level", "top", "path", "carry", "key", "salt"):
            docs = docs.withColumn(c, F.lit("clash"))
        built, got = manifest_rows(spark, docs, fanout)
        assert asked(got) == asked(plain_manifest(rows, fanout))
        nodes = built.nodes()
        assert nodes.where("hi < lo or hi >= n").count() == 0
        assert nodes.where("tree = 'root' and lo = 0 and hi = n - 1").select("digest").first()[0] == built.root
    finally:
        merkle.SPAN = old


def test_manifest_edges(spark):
    rows = [tuple(r) for r in edges(spark).select(*FIELDS).collect()]
    assert asked(manifest_rows(spark, edges(spark))[1]) == asked(plain_manifest(rows))
    built, got = manifest_rows(spark, empty(spark))
    assert got == [] and built.root is None
    one = edges(spark).where("doc_id = 2")
    got = manifest_rows(spark, one)[1]
    assert got[0].leaf == got[0].subroot == got[0].root and got[0].p == sha("")
