"""Quality, sharding, top-k, mixing, fingerprints: held-out accuracy, laws and brute force, with edges."""

import heapq
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from laborlens.llm import fingerprint, mixing, quality, sharding, topk
from llm_data import SF, edges, empty, generated, texts_of


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_held_out_accuracy(spark):
    got = quality.quality_scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"),
                                 spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    rows = got.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out").collect()
    right = [r.predicted == r.quality for r in rows]
    assert len(rows) > 40 and np.mean(right) >= 0.95
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert got.count() == 1000


def test_quality_edges(spark):
    got = quality.quality_scores(edges(spark), labels(spark)).collect()
    assert len(got) == edges(spark).count() and all(0 <= r.score <= 1 for r in got)
    assert quality.quality_scores(empty(spark), labels(spark)).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(edges(spark), none).collect()} == {0.5}
    one = spark.createDataFrame([(2, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(edges(spark), one).collect()} <= {0.5, 1.0}
    kept = quality.filter_quality(edges(spark), none)
    assert kept.columns == edges(spark).columns and kept.count() == edges(spark).count()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=30))
def test_isotonic_is_the_closest(pairs):
    v, w = (np.array(x, dtype=float) for x in zip(*pairs, strict=True))
    got = quality.isotonic(v, w)
    assert (np.diff(got) >= -1e-12).all()
    # min-max formula of isotonic regression
    n = len(v)
    mean = lambda a, b: (v[a:b] * w[a:b]).sum() / w[a:b].sum()
    want = [max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)]
    assert np.allclose(got, want)


@pytest.mark.parametrize("table", [edges, generated, empty])
def test_sharding(spark, table):
    df = table(spark)
    got = sharding.shard_documents(df, 4).collect()
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts_of(df)]
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == sorted(want, key=repr)
    by_text, load = {}, [0] * 4
    for r in got:
        by_text.setdefault(r.text_crc32, set()).add(r.shard)
        load[r.shard] += r["size"]
    assert all(len(s) == 1 for s in by_text.values())
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    if table is generated:
        largest = max(sum(r["size"] for r in got if r.text_crc32 == c) for c in by_text)
        assert max(load) - min(load) <= largest


def test_least_loaded_is_lpt():
    sizes = sorted([7, 7, 6, 5, 5, 4, 3, 3, 2, 1, 1], reverse=True)
    heap, want = [(0, b) for b in range(3)], []
    for s in sizes:
        load, b = heapq.heappop(heap)
        want.append(b)
        heapq.heappush(heap, (load + s, b))
    assert sharding.least_loaded(sizes, 3) == want


def test_ridge_scores_equal_one_solve_over_all_rows(spark):
    """Partition sums give the least squares of the whole matrix with its penalty."""
    r = np.random.default_rng(8)
    x = r.normal(size=(700, len(quality.STATS))) * r.uniform(0.5, 3, len(quality.STATS))
    y = (x[:, 0] + np.sin(2 * x[:, 1]) + r.normal(size=700) * 0.3 > 0).astype(int)
    rows = [(x[i].tolist(), int(y[i]), i % 5 == 1) for i in range(700)]
    model = quality.fit(spark.createDataFrame(rows, "stats array<double>, label int, fold boolean").repartition(7))
    stay = np.array([not f for _, _, f in rows])
    a = model.features(x[stay])
    n, d = a.shape
    penalty = np.full(d, quality.RIDGE * n)
    penalty[-1] = 1e-9 * n
    weights, *_ = np.linalg.lstsq(np.vstack([a, np.diag(np.sqrt(penalty))]), np.concatenate([y[stay], np.zeros(d)]), rcond=None)
    assert np.allclose(model.raw(x), model.features(x) @ weights, atol=1e-6)
    # calibrated values are the isotonic fit of the calibration fold: non-decreasing, and its mean is kept
    assert (np.diff(model.values) >= 0).all()
    fold = model.score(x[~stay])
    assert abs(fold.mean() - y[~stay].mean()) < 0.05


def test_fourier_features_approximate_the_gaussian_kernel():
    r = np.random.default_rng(9)
    model = quality.Model(np.zeros(len(quality.STATS)), np.ones(len(quality.STATS)), None, np.zeros(1), np.zeros(1), 0.5)
    x = r.normal(size=(60, len(quality.STATS)))
    f = model.features(x)[:, :quality.FEATURES]
    exact = np.exp(-quality.GAMMA * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert abs(f @ f.T - exact).max() < 0.3 and abs(f @ f.T - exact).mean() < 0.06


def brute_topk(rows, k):
    vec = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vec.setdefault(i, []).append([int(np.floor(256 * x)) for x in v])
    out = []
    for q in vec:
        if q % 50 == 0:
            for qv in vec[q]:
                found = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), c) for c in vec for v in vec[c]
                               if c != q and len(v) == len(qv))
                out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(found[:k])]
    return sorted(out)


def test_topk(spark, monkeypatch):
    r = np.random.default_rng(5)
    rows = [(i, np.round(r.normal(size=4), 2).tolist()) for i in range(230)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan"), 0.0, 0.0, 0.0]), (None, [0.1] * 4),
             (303, [float("inf"), 0.0, 0.0, 0.0]), (350, [0.5, 0.5]), (351, [0.5, -0.5]), (400, []), (401, rows[3][1])]
    schema = "vec_id long, embedding array<double>, id string, vec string, score string"
    df = spark.createDataFrame([(*x, "c", "c", "c") for x in rows], schema).repartition(3)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "BLOCKS_PER_CELL", 1)
    monkeypatch.setattr(topk, "FAN", 3)
    got = topk.exact_topk(df, F.col("vec_id") % 50 == 0, k=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(x) for x in got.collect()) == brute_topk(rows, 5)
    assert topk.exact_topk(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("scale", [1, 1 << 24, 1 << 30, 1 << 61])
def test_products_are_exact(scale):
    r = np.random.default_rng(6)
    q, c = r.integers(-3, 4, (5, 3)) * scale, r.integers(-3, 4, (7, 3)) * scale
    want = [[max(-(1 << 63), min((1 << 63) - 1, sum(int(a) * int(b) for a, b in zip(x, y, strict=True)))) for y in c] for x in q]
    assert topk.products(q, c).tolist() == want


def brute_targets(sizes, weights=(5, 2, 1)):
    """Share, stop at the cap, share the excess again by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in full else share[s] for s in names}
        full |= above


def test_mixing_targets(spark):
    r = np.random.default_rng(7)
    for k in range(4):
        sizes = {f"s{i}": int(r.integers(0, 1000) ** 2 // (i + 1)) for i in range(r.integers(2, 9))} | {None: 500 * k}
        df = spark.createDataFrame([(s, v) for s, v in sizes.items()], "source string, size long")
        got = {x.source: x.target for x in mixing.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


@pytest.mark.parametrize("table", [edges, generated, empty])
def test_mixing(spark, table, monkeypatch):
    df = table(spark)
    once = mixing.mix(df).collect()
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 3)  # many buckets, the same order
    again = mixing.mix(df.repartition(5)).collect()
    pick = lambda rows: sorted(((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in rows), key=repr)
    assert pick(once) == pick(again)
    assert len(once) == df.count()
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in once)
    text = {i: t for i, t in texts_of(df)}
    for r in once:
        if r.doc_id is not None:
            assert r["size"] == len((text[r.doc_id] or "").encode().split())
    source = {x.doc_id: x.source for x in df.select("doc_id", "source").collect()}
    taken, target, largest = {}, {}, {}
    for r in once:
        if r.doc_id is not None:
            s = source[r.doc_id]
            taken[s] = taken.get(s, 0) + r.taken
            target[s] = r.target
            largest[s] = max(largest.get(s, 0), r["size"])
    if table is generated:
        assert all(abs(taken[s] - target[s]) <= 2 * largest[s] for s in taken)


def test_mixing_repeated_ids_with_different_texts_agree_on_every_rerun(spark, monkeypatch):
    """120 rows, ids that repeat or are missing, texts of many sizes: any order and partitioning mixes alike."""
    r = random.Random(3)
    rows = [(r.choice([7, None, None, i]), " ".join(["w%d" % (i % 9)] * r.randint(0, 40)), r.choice(["a", "b", None]))
            for i in range(117)] + [(7, "same same", "a")] * 3
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 7)
    monkeypatch.setattr(mixing, "FINE", 3)
    schema = "doc_id long, text string, source string"
    results, mixes = [], []
    for order, parts in ((rows, 1), (rows[::-1], 3), (r.sample(rows, len(rows)), 5)):
        df = spark.createDataFrame(order, schema).repartition(parts)
        results.append(sorted(((x.doc_id, x["size"], x.source_size, x.target, x.taken) for x in mixing.mix(df).collect()), key=repr))
        mixes.append(sorted(map(repr, mixing.mixed_documents(df).collect())))
    assert results[0] == results[1] == results[2] and mixes[0] == mixes[1] == mixes[2]
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(rows, schema).toPandas())
    want = con.execute(mixing.mix_sql().replace("doc_id, source, len(", "doc_id::BIGINT AS doc_id, source, len(")).fetchall()
    assert sorted((x[:2] + x[4:] for x in results[0]), key=repr) == sorted(((d, n, t) for d, n, _, _, t in want), key=repr)


def test_sums_before_two_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FINE", 4)
    rows = [(g, a, (a * 7 + len(g or "x")) % 11) for g in ("a", "b", None) for a in range(0, 50, 3)]
    df = spark.createDataFrame(rows, "g string, at long, words long")
    got = {(x.g, x.at): x.out for x in mixing.sums_before(df, ["g"], "at", "words", "out").collect()}
    assert got == {(g, a): sum(w for h, b, w in rows if h == g and b < a) for g, a, _ in rows}


def test_mixed_documents(spark):
    df = edges(spark)
    taken = mixing.mix(df).collect()
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    assert out.count() == sum(r.passes for r in taken)


def test_fingerprints_are_local():
    from llm_data import words
    a, b = words(400, 11), words(400, 12)
    fa, fb, shifted, half = fingerprint.fingerprints([a, b, "zz " + a, fingerprint.edit(a, b)])
    assert fingerprint.likeness(fa, fa) == 1.0
    assert fingerprint.likeness(fa, shifted) > 0.8
    assert fingerprint.likeness(fa, fb) < 0.1 < 0.2 < fingerprint.likeness(fa, half) < 0.6
    assert fingerprint.fingerprints([None, ""])[0] == fingerprint.EMPTY
    assert fingerprint.likeness(fingerprint.EMPTY, fa) == 0.0 and fingerprint.likeness(fingerprint.EMPTY, fingerprint.EMPTY) == 1.0


def plain_phrases(text):
    """The parse from its definition, one unit after the other: (root name, hashes of the phrase names)."""
    full = (1 << 64) - 1

    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & full
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & full
        return x ^ x >> 31

    def toss(values, bits):
        out = []
        for i, v in enumerate(values):
            left = values[i - 1] if i else ~v & (1 << bits) - 1
            place = next(k for k in range(bits) if (v ^ left) >> k & 1)
            out.append(place << 1 | v >> place & 1)
        return out

    symbols, level, found = [int(fingerprint.BYTE[b]) for b in text.encode()], 0, set()
    while level == 0 or len(symbols) > 1:
        units = []
        for value in symbols:
            if units and units[-1][0] == value:
                units[-1][1] += 1
            else:
                units.append([value, 1])
        names = [v if n == 1 else mix(v + n * 0xC2B2AE3D27D4EB4F & full) for v, n in units]
        labels = toss(toss(toss(names, 64), 8), 8)
        cuts = [0] + [i for i in range(1, len(names) - 1) if labels[i - 1] < labels[i] > labels[i + 1]] + [len(names)]
        symbols = [mix(sum(names[a + j] * pow(0x9E3779B97F4A7C15, j, 1 << 64) for j in range(b - a)) & full)
                   for a, b in zip(cuts, cuts[1:], strict=False)]
        level += 1
        if level >= fingerprint.LOW or len(symbols) == 1:
            found |= {mix(x + 0x9E3779B97F4A7C15 & full) >> 32 for x in symbols}
    return symbols[0], found


def test_fingerprints_equal_a_plain_parse():
    from llm_data import edge_texts, words
    texts = [t for _, t, _ in edge_texts() if t and len(t) < 3000] + [words(n, n) for n in (1, 2, 3, 5, 40, 200)]
    texts += ["a", "ab", "aba", "aab" * 50, "abcab" * 30, "\x00\x00", "é" * 9]
    sets = []
    for text, got in zip(texts, fingerprint.fingerprints(texts), strict=True):
        root, found = plain_phrases(text)
        sets.append(found)
        assert got == f"{root:016x}:" + "".join(f"{v:08x}" for v in sorted(found)[:fingerprint.SKETCH]), text[:50]
    marks = fingerprint.fingerprints(texts)
    for a, b, x, y in ((a, b, x, y) for a, x in zip(marks, sets) for b, y in zip(marks, sets)):
        if len(x | y) <= fingerprint.SKETCH:  # the sketches are the sets
            assert fingerprint.likeness(a, b) == pytest.approx(1.0 if a[:16] == b[:16] else len(x & y) / len(x | y))


def test_likeness_is_near_the_true_likeness_of_phrase_sets():
    from llm_data import words
    base = words(900, 21)
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        at = int(len(base) * share)
        other = base[:at] + words(900, 22)[at:]
        x, y = plain_phrases(base)[1], plain_phrases(other)[1]
        got = fingerprint.likeness(*fingerprint.fingerprints([base, other]))
        assert abs(got - len(x & y) / len(x | y)) < 0.2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=300) | st.text("ab", max_size=300), max_size=6))
def test_fingerprint_of_a_batch_is_that_of_each(texts):
    assert fingerprint.fingerprints(texts) == [fingerprint.fingerprints([t])[0] for t in texts]


@pytest.mark.parametrize("table", [edges, generated, empty])
def test_edited_fingerprints(spark, table):
    df = table(spark)
    rows = texts_of(df)
    texts = [t or "" for _, t in rows]
    after = texts[1:] + texts[:1]
    edited = [a[:len(a) - len(a) // 2] + b[:len(a) // 2] for a, b in zip(texts, after, strict=True)]
    fp, ep = fingerprint.fingerprints(texts), fingerprint.fingerprints(edited)
    want = [(i, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, fingerprint.likeness(f, g), fingerprint.likeness(f, h))
            for (i, _), t, e, f, g, h in zip(rows, texts, edited, fp, ep, fp[1:] + fp[:1], strict=True)]
    got = [tuple(r) for r in fingerprint.edited_fingerprints(df).select(
        "doc_id", "n_chars", F.sha2("edited", 256), "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert fingerprint.fingerprint_documents(df).count() == len(rows)
