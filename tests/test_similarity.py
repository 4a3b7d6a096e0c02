"""X1 company match: ratio, cutoff, ties, short names; native == vectorised."""

from laborlens.functions import dictionaries as D
from laborlens.functions.similarity import best_match_batch, py_token_sort, with_company_norm


def ratio(a, b):
    a, b = py_token_sort(a), py_token_sort(b)
    n, m = len(a), len(b)
    dp = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n):
        for j in range(m):
            dp[i + 1][j + 1] = dp[i][j] + 1 if a[i] == b[j] else max(dp[i][j + 1], dp[i + 1][j])
    return 200.0 * dp[n][m] / (n + m)


def brute(name, canon, cutoff=72):
    s = (name or "").strip()
    if name is None or len(s) < 2:
        return ""
    best, pick = -1.0, None
    for c in canon:
        r = ratio(s, c)
        if r > best:
            best, pick = r, c
    return pick if best >= cutoff else s.title()


NAMES = ["Infosys Limited", "Infosys", "Mahindra Techs", "tech mahindra", "Cyient Limited", "X", " ", None,
         "Customer#000000097", "Customer#000000907", "Customer#000000098", "Zomato Ltd", "Paytm Money"]


def test_reference_ratios():
    assert round(ratio("Infosys Limited", "Infosys"), 1) == 63.6
    assert round(ratio("Mahindra Techs", "Tech Mahindra"), 1) == 96.3
    assert ratio("Cyient Limited", "ITC Limited") == 72.0


def test_match_against_brute_force(spark):
    canon = D.CANONICAL_COMPANIES + D.fixture_canonical_names()
    df = spark.createDataFrame([(n,) for n in NAMES], "name string")
    for method in ("native", "vectorized"):
        got = [r["norm"] for r in with_company_norm(df, "name", "norm", canon, method=method).collect()]
        assert got == [brute(n, canon) for n in NAMES], method


def test_inclusive_cutoff_and_first_best():
    out = best_match_batch([py_token_sort("Cyient Limited")], D.CANONICAL_COMPANIES, 72)
    assert list(out) == ["ITC Limited"]
    # several fixture forms clear the cutoff for this name; the highest ratio wins
    canon = D.fixture_canonical_names()
    out = best_match_batch(["Customer#000000907"], canon, 72)
    assert list(out) == [brute("Customer#000000907", canon)] == ["Customer#3007"]
    # equal ratios: the earlier entry wins
    assert list(best_match_batch(["ab cd"], ["cd abx", "ab cdx"], 72)) == ["cd abx"]


def test_long_names_and_long_canonical_names(spark):
    """Canonical names beyond one machine word, in both forms; a very long name costs little."""
    import tracemalloc

    from laborlens.functions.similarity import best_match_batch, with_company_norm
    canon = ["International Consolidated Widgets and Gadgets Manufacturing Corporation of the World", "ITC Limited"]
    assert len(canon[0]) > 70
    names = ["Corporation International Consolidated Widgets and Gadgets Manufacturing of the Wrld", "ITC Limitd", "zz"]
    want = [canon[0], canon[1], None]
    assert best_match_batch([" ".join(sorted(n.split())) for n in names], canon, 75).tolist() == want
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for method in ("native", "vectorized"):
        got = [r.o for r in with_company_norm(df, "n", "o", canon, 75, method=method).collect()]
        assert got == [canon[0], canon[1], "Zz"]
    tracemalloc.start()
    best_match_batch(["short name"] * 2000 + ["x" * 20_000], ["ITC Limited"], 75)
    assert tracemalloc.get_traced_memory()[1] < 50 << 20
    tracemalloc.stop()


def test_pairs_beyond_reach_cost_no_comparison(monkeypatch):
    """names that share too few characters with a canonical one are not compared with it; the match stays that of brute force."""
    import numpy as np
    rows = []
    count = np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: rows.append(len(x)) or count(x))
    canon = ["abcd efgh", "zzzz yyyy", "abcd efgx"]
    names = ["abcd efgh", "abcd efgz", "mnop qrst", "zzzz yyyx"] * 5
    got = best_match_batch([py_token_sort(n) for n in names], canon, 72)
    assert [g or n.title() for g, n in zip(got, names)] == [brute(n, canon) for n in names]
    assert sum(rows) <= 25  # all 60 pairs before
