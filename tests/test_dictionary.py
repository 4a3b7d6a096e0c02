"""One automaton per dictionary against the CASE form and plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from laborlens.functions import dictionaries as D
from laborlens.functions import text as X
from laborlens.operators.dictionary import Dictionary, alias_table, keyword_table
from laborlens.plans.silver import fixture_dictionaries

TEXTS = [None, "", "navi mumbai and mumbai", "nation_10 nation_1", "in bengaluru, then new delhi", "industries of money", "tcs and infosys",
         "a tech mahindra hr services firm", "gurgaon/delhi ncr", "nothing here", "x" * 5000 + " pune", "日本 mumbai", "hyderabadi pune"]


def plain(text, entries):
    hits = [] if text is None else [(k, v, p) for k, (p, v) in entries.items() if k in text]
    if not hits:
        return None, None, 0
    first = min(hits, key=lambda h: (h[2], h[0]))
    return first[1], min(hits, key=lambda h: (text.index(h[0]), -len(h[0])))[0], len(hits)


@pytest.mark.parametrize("max_bytes", [1 << 20, 300])
def test_random_dictionary(spark, max_bytes):
    r = random.Random(4)
    word = lambda a, b: "".join(r.choice("abcd") for _ in range(r.randint(a, b)))
    rows = [(word(1, 6), f"v{i}", r.randint(0, 40)) for i in range(150)] + [("", "empty", 30), (None, "null", 0)]
    entries = {}
    for k, v, p in rows:
        if k is not None:
            entries[k] = min(entries.get(k, (p, v)), (p, v))
    texts = [word(0, 60) for _ in range(120)] + TEXTS
    table = spark.createDataFrame(rows, "key string, value string, priority long").repartition(3)
    made = Dictionary(table, max_bytes)
    assert (made.parts > 1) == (max_bytes == 300)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(2)
    got = {x.i: (x.m.first.value if x.m.first else None, x.m.earliest_key, x.m.n_keys) for x in made.match(df, "t", "m").collect()}
    assert got == {i: plain(t, entries) for i, t in enumerate(texts)}


def test_ten_thousand_keys(spark):
    table = spark.range(10_000).select(F.concat(F.lit("key"), F.col("id"), F.lit(";")).alias("key"),
                                       F.col("id").cast("string").alias("value"), (F.lit(10_000) - F.col("id")).alias("priority"))
    df = spark.createDataFrame([("key5; and key77; and key9999x",), ("none",)], "t string")
    got = [(x.m.first.value if x.m.first else None, x.m.n_keys) for x in Dictionary(table).match(df, "t", "m").collect()]
    assert sorted(got, key=str) == [("77", 2), (None, 0)]


def test_equal_to_the_case_forms(spark):
    dic = fixture_dictionaries()
    df = spark.createDataFrame([(t,) for t in TEXTS + [t.title() for t in TEXTS if t]], "t string")
    low = F.lower("t")
    city, sector, known, mention = (Dictionary(x) for x in (
        alias_table(spark, dic.city_aliases), keyword_table(spark, dic.sectors),
        alias_table(spark, [(k.lower(), k) for k in D.KNOWN_COMPANIES]), alias_table(spark, [(c, c) for c in D.MENTION_CITIES])))
    out = mention.match(known.match(sector.match(city.match(df, low, "city"), low, "sector"), low, "known"), low, "mention")
    value = lambda c: F.col(f"{c}.first.value")
    rows = out.select(
        "t", value("city").alias("a"), X.first_contained(low, dic.city_aliases).alias("a2"),
        F.coalesce(value("sector"), F.lit("Other")).alias("b"), X.classify_keywords(F.coalesce(low, F.lit("")), dic.sectors).alias("b2"),
        F.coalesce(value("known"), F.lit("")).alias("c"), X.extract_company("t", patterns=(), guards=()).alias("c2"),
        F.coalesce(X.title_case("mention.earliest_key"), F.lit("")).alias("d"), X.extract_city("t").alias("d2")).collect()
    for x in rows:
        assert (x.a, x.b, x.c, x.d) == (x.a2, x.b2, x.c2, x.d2), x
    assert sum(x.a is not None for x in rows) > 5 and len({x.b for x in rows}) > 2


def test_empty_dictionary(spark):
    df = spark.createDataFrame([("a",), (None,)], "t string")
    made = Dictionary(spark.createDataFrame([], "key string, value string, priority long"))
    assert [(x.m.first, x.m.n_keys) for x in made.match(df, "t", "m").collect()] == [(None, 0)] * 2
