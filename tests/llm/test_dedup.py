"""Line dedup, suffix dedup, near duplicates: against brute force, with edges."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from laborlens.llm import line_dedup, minhash, suffix_dedup
from llm_data import edges, empty, generated, texts_of

TABLES = pytest.mark.parametrize("table", [edges, generated, empty])


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def brute_lines(rows):
    """(doc_id, n_lines, n_dropped, kept); null ids are one document after all others."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                                                      "abcdefghijklmnopqrstuvwxyz"))
    order = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            first[key(x)] = min(first.get(key(x), float("inf")), order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or first[key(x)] == order(i)]
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@TABLES
@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2)])
def test_line_dedup(spark, table, batches, fanout):
    df = table(spark)
    got = line_dedup.rebuilt_rows(df, batches=batches, fanout=fanout).select("row.doc_id", "n_lines", "n_dropped", "kept")
    assert plain(got.collect()) == plain(brute_lines(texts_of(df)))


def test_line_dedup_null_text_beside_a_row_that_loses_lines(spark):
    line = "a line that is long enough to be a key"
    rows = [(1, line), (2, None), (2, line), (None, None), (None, line), (2, line + "\nown words of row two")]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = line_dedup.rebuilt_rows(df, batches=2).select("row.doc_id", "n_lines", "n_dropped", "kept")
        assert plain(got.collect()) == plain(brute_lines(rows))


def test_line_dedup_keeps_columns(spark):
    df = edges(spark)
    out = line_dedup.dedup_lines(df, batches=2)
    assert out.columns == df.columns
    assert Counter(r.source for r in out.collect()) == Counter(r.source for r in df.collect())


def test_a_batch_meets_the_runs_without_a_shuffle(spark):
    """Keys and runs are bucketed alike: the anti-joins read them as they lie."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = line_dedup.Runs(spark, 3, 4)
        made = lambda a, b: line_dedup.keep_bucketed(
            spark.range(a, b).selectExpr("cast(cast(id as string) as binary) as h"), "test_run", 3, "h")
        for k in range(2):
            runs.add(made(k * 10, k * 10 + 10))
        new = runs.unseen(made(5, 40))
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert sorted(int(bytes(r.h)) for r in new.collect()) == list(range(20, 40))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("sort", [False, True])
def test_bucketed_tables_lie_in_the_shared_folder(spark, sort):
    """The session's warehouse, which executors may not share or write, is not used."""
    t = line_dedup.keep_bucketed(spark.range(50).selectExpr("id % 7 as k", "id"), "test_place", 3, "k", sort=sort)
    base = spark.sparkContext.getCheckpointDir().split(":", 1)[-1].lstrip("/")
    assert t.inputFiles() and all(f.split(":", 1)[-1].lstrip("/").startswith(f"{base}/") for f in t.inputFiles())
    assert sorted((r.k, r.id) for r in t.collect()) == sorted((i % 7, i) for i in range(50))


def test_runs_are_levelled(spark):
    """After many batches few runs are left, and together they hold every hash once."""
    runs = line_dedup.Runs(spark, 2, 3)
    for k in range(7):
        run = spark.range(k * 10, k * 10 + 10).selectExpr("cast(cast(id as string) as binary) as h")
        runs.add(line_dedup.keep_bucketed(run, "test_run", 2, "h"))
    assert [len(level) for level in runs.levels] == [1, 2]
    assert runs.all().distinct().count() == 70 == runs.all().count()


def brute_repeats(rows, length=100):
    seen, out = set(), []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = True
            seen.add(w)
        edge = gone & ~np.r_[False, gone[:-1]] if len(b) else gone
        out.append((i, len(b), int(gone.sum()), int(edge.sum()), np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


@TABLES
def test_suffix_dedup(spark, table):
    df = table(spark)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect()]
    assert sorted(got, key=repr) == sorted(brute_repeats(texts_of(df)), key=repr)


def test_suffix_dedup_other_length(spark):
    df = edges(spark)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in suffix_dedup.remove_repeats(df, length=40).collect()]
    assert sorted(got, key=repr) == sorted(brute_repeats(texts_of(df), 40), key=repr)


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=0, max_size=400), st.integers(1, 3))
def test_sampling_is_local(text, times):
    """Every window picks one position, the same wherever the window stands."""
    raw = np.frombuffer((text * times).encode(), np.uint8)
    starts, picks = suffix_dedup.sample(raw, 40, 32)
    windows = {}
    for p in range(len(raw) - 39):
        k = int(np.searchsorted(starts, p, side="right")) - 1
        assert p <= picks[k] <= p + 8
        assert windows.setdefault(raw[p:p + 40].tobytes(), picks[k] - p) == picks[k] - p


def word_sets(rows):
    out = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\t", " ").replace("\n", " ").replace(
            "\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
        w = [x for x in w if x]
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_components(rows):
    sets, parent = word_sets(rows), {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(rows[a][0]), find(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, _), s in zip(rows, sets, strict=True)]


@TABLES
def test_near_duplicates(spark, table):
    df = table(spark)
    assert plain(minhash.near_duplicates(df).collect()) == plain(brute_components(texts_of(df)))


def chained(spark):
    """A chain of near copies whose ends are not linked, and many texts that share half of their words."""
    w = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(12):
        rows.append((k, " ".join(w)))
        w[5 * k] = f"new{k}"
    common = " ".join(f"c{i}" for i in range(40))
    rows += [(100 + k, common + " " + " ".join(f"t{k}x{i}" for i in range(25))) for k in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_near_duplicates_chain_and_crowded_buckets(spark):
    df = chained(spark)
    assert plain(minhash.near_duplicates(df).collect()) == plain(brute_components(texts_of(df)))


def test_drop_near_duplicates(spark):
    df = edges(spark)
    want = {i for i, _, _, kept in brute_components(texts_of(df)) if kept}
    out = minhash.drop_near_duplicates(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == want


def test_signature_estimates_similarity():
    r = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        a = r.integers(0, 1 << 62, 80).astype(np.uint64)
        b = np.concatenate([a[:60], r.integers(0, 1 << 62, 20).astype(np.uint64)])
        s = minhash.super_minhash([np.unique(a), np.unique(b)])
        errors.append((s[0] == s[1]).mean() - 60 / 100)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_every_rank_is_a_permutation():
    """One element's signature holds every step's rank once."""
    s = minhash._signatures([np.array([12345], dtype=np.uint64)], 16)
    assert len(set(s[0].tolist())) == 16


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (20, 21), (30, 30)] + [(100, k) for k in range(101, 160)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {(r.node, r.root) for r in minhash.components(df).collect()}
    assert got == {(n, 1) for n in (2, 3, 7, 8, 9)} | {(21, 20)} | {(k, 100) for k in range(101, 160)}
