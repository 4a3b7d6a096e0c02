"""The indexed similarity join against comparing all names with all canonical names."""

import itertools
import random

import numpy as np
import pytest

from laborlens.functions.similarity import py_token_sort
from laborlens.operators import similarity_join as J


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def plain(names, canon, cutoff):
    out = {}
    table = [(p, c, py_token_sort(c)) for c, p in canon if py_token_sort(c or "")]
    for name in set(names):
        a = py_token_sort(name or "")
        if not a:
            continue
        best = min(((-(100.0 if a == b else 200.0 * lcs(a, b) / (len(a) + len(b))), p, c) for p, c, b in table), default=None)
        if best and -best[0] >= cutoff:
            out[name] = (best[2], round(-best[0], 9))
    return out


def word(r, alphabet="abcdefghij"):
    return "".join(r.choice(alphabet) for _ in range(r.randint(1, 9)))


def spoiled(r, name):
    parts = name.split()
    r.shuffle(parts)
    s = list(" ".join(parts))
    for _ in range(r.randint(0, 4)):
        at = r.randrange(len(s) + 1)
        s[at:at + r.randint(0, 1)] = r.choice(["", "x", "é", " Ltd"])
    return "".join(s)


@pytest.mark.parametrize("cutoff", [72, 60, 85.5, 100])
def test_join_equals_all_pairs(spark, cutoff, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 3)  # every common combination is cut
    r = random.Random(int(cutoff))
    canon = [(" ".join(word(r) for _ in range(r.randint(1, 4))), i) for i in range(120)]
    canon += [("a", 200), ("ab", 201), ("abc", 202), (canon[5][0], 3), ("", 0), (None, 1), ("  ", 2),
              (" ".join(word(r) for _ in range(15)), 203), ("日本 電気", 204), ("😀 corp", 205)]
    names = [spoiled(r, c) for c, _ in canon if c and c.strip() for _ in range(2)] + [None, "", " ", "zzz", "ba", "abd", "電気 日本", "corp 😀s"]
    df = spark.createDataFrame([(n,) for n in names + names[:9]], "name string").repartition(3)
    table = spark.createDataFrame(canon, "name string, priority int").repartition(2)
    join = J.BestMatch(df, table, cutoff)
    got = {x["name"]: (x["match"], round(x["score"], 9)) for x in join.matches.collect()}
    assert got == plain(names, canon, cutoff)
    assert join.candidates < len(set(names)) * len(canon) / (2 if cutoff < 70 else 4)


def test_plan_has_no_cross_product(spark):
    names = spark.createDataFrame([(1, "acme corp")], "id long, sorted string")
    canon = spark.createDataFrame([(2, "acme")], "id long, sorted string")
    plan = J.candidates(names, canon, 72.0, {})._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_names_with_common_characters_only(spark):
    """Names of one pattern: every pair shares most characters, and the best match is still exact."""
    canon = [(f"Customer#{i:05d}", i) for i in range(60)]
    names = [f"Customer#{i:05d}".replace("0", "", 1) for i in range(0, 90, 3)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = J.best_matches(df, spark.createDataFrame(canon, "name string, priority int"))
    assert {x["name"]: (x["match"], round(x["score"], 9)) for x in got.collect()} == plain(names, canon, 72)


def test_empty_sides(spark):
    none = spark.createDataFrame([], "name string, priority int")
    some = spark.createDataFrame([("acme", 0)], "name string, priority int")
    assert J.best_matches(none, some).count() == 0 == J.best_matches(some, none).count()


def test_lcs_of_pairs_long_and_empty():
    r = random.Random(1)
    pairs = [("", "abc"), ("abc", ""), ("", ""), ("日本", "本日")]
    pairs += [("".join(r.choice("abc ") for _ in range(r.randint(1, 200))), "".join(r.choice("abc ") for _ in range(r.randint(1, 200))))
              for _ in range(60)]
    assert J.lcs_of_pairs(*zip(*pairs, strict=True)).tolist() == [lcs(a, b) for a, b in pairs]


def test_candidates_are_not_multiplied_by_their_combinations(spark):
    """A pair that shares many combinations comes once out of the join, with no shuffle of pairs behind it."""
    r = random.Random(5)
    spell = lambda: " ".join(sorted(word(r, "abcdefg") for _ in range(2)))
    names, canon = (sorted({spell() for _ in range(150)}) for _ in range(2))
    table = spark.createDataFrame(list(enumerate(canon)), "id long, sorted string")
    rank = J.element_ranks(table)
    assert len(rank) <= J.EXACT
    got = J.candidates(spark.createDataFrame(list(enumerate(names)), "id long, sorted string"), table, 72.0, rank)
    assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()
    pairs = [tuple(x) for x in got.collect()]
    # short names meet under combinations of more than one size
    assert len(pairs) <= len(set(pairs)) * 1.25
    alike = {(i, j) for i, a in enumerate(names) for j, b in enumerate(canon) if 200 * lcs(a, b) >= 72 * (len(a) + len(b))}
    assert alike <= set(pairs)


@pytest.mark.parametrize("exact", [0, 3, 96])
def test_signatures_and_earlier_bits(exact, monkeypatch):
    """Bits against sets: no overlap is understated, and only a shared earlier element is ever reported."""
    monkeypatch.setattr(J, "EXACT", exact)
    r = random.Random(exact)
    listed = np.array([ord(c) << 24 | n for n in (2, 1, 0) for c in "abc "], np.int64)
    for size in (1, 5, 9):
        names = ["".join(r.choice("abcdé日 ") for _ in range(size)) for _ in range(40)]
        keys = J.element_keys(names, listed)
        plain = [{(c, x[:i].count(c)) for i, c in enumerate(x)} for x in names]
        bits = J.element_bits(keys, len(listed))
        signed = [tuple(int(h) % (1 << 64) for h in x) for x in zip(*J.halves(bits), strict=True)]
        for i in range(40):
            for j in range(40):
                assert len(set(keys[i]) & set(keys[j])) == len(plain[i] & plain[j])
                missed = sum((a & ~b).bit_count() for a, b in zip(signed[i], signed[j], strict=True))
                assert missed <= len(plain[i] - plain[j])
        for m in range(1, min(size, 3) + 1):
            places = np.array(list(itertools.combinations(range(size), m)))
            masks = [[int(h) % (1 << 64) for h in x.ravel()] for x in J.earlier_bits(bits[:, places])]
            for i in range(40):
                for at, place in enumerate(places):
                    earlier = set(keys[i][:place[-1]]) - set(keys[i][place])
                    mask = masks[0][i * len(places) + at] << 64 | masks[1][i * len(places) + at]
                    own = signed[i][0] << 64 | signed[i][1]
                    told = (mask & own).bit_count()
                    owns = [k for k in earlier if J.LISTED + len(listed) - 1 - k < exact and k >= J.LISTED]
                    # an own bit is reported only of elements rarer than the last one, if that has one too
                    last = keys[i][place[-1]]
                    has = last >= J.LISTED and J.LISTED + len(listed) - 1 - last < exact
                    assert told == (len(owns) if has else 0)


def test_query_reads_the_texts_once(spark, tmp_path, monkeypatch):
    """Names and table come from one written copy of the first words, whatever the texts begin with."""
    from laborlens.catalog import matching as M
    texts = ["acme corp and more", "  acme\tcorp", "acme corp", "acme", "", None, "\nacme corp x", "a corp x", "acme  corp ",
             "x" * 300 + " " + "y" * 300 + " z", " " * 400 + "late words here", "one " + " \t" * 200 + "two three", "日本 電気 x"]
    spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(
        str(tmp_path / "documents.parquet"))
    words = {r.doc_id: (r.w1, r.w2) for r in M._words(spark, str(tmp_path)).collect()}
    assert words == {0: ("acme", "corp"), 1: ("acme", "corp"), 2: ("acme", "corp"), 8: ("acme", "corp"), 9: ("x" * 24, "y" * 24),
                     10: ("late", "words"), 11: ("one", "two"), 12: ("日本", "電気")}
    seen = {}
    monkeypatch.setattr(M, "best_matches", lambda names, canon: seen.update(names=names, canon=canon) or canon.selectExpr(
        "name", "name AS match", "100D AS score"))
    M.q_similarity_join(spark, str(tmp_path))
    for df in seen.values():
        assert not any("documents.parquet" in f for f in df.inputFiles())
