"""Steps whose cost a row must stay small on large tables: what their plans sort, parse and write."""

import re

from pyspark.sql import functions as F

from laborlens.catalog import core
from laborlens.functions.dates import parse_published
from laborlens.functions.scoring import signal_score, tenths_of_count
from laborlens.operators.dedupe import keep_first
from laborlens.plans import silver

NEWS = ("title string, description string, company string, city string, headcount string, signal_type string, "
        "published_at string, url string, source_name string, source string, scraped_at string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_sorts_by_a_number_first(spark):
    rows = [("https://a.example/1", "t", "2"), ("https://a.example/1", "t", "1"), (None, "t", "3"), (None, "t", None),
            ("https://a.example/1", None, "5"), ("https://a.example/1", None, "4"), ("", "t", "9")]
    df = spark.createDataFrame(rows, "url string, title string, at string")
    kept = keep_first(df, ["url", "title"], ["at"])
    sorts = re.findall(r"Sort \[(\S+) ASC", plan(kept))
    assert sorts and not any(s.startswith(("url", "title")) for s in sorts)
    assert kept.columns == df.columns
    assert {tuple(r) for r in kept.collect()} == {("https://a.example/1", "t", "1"), (None, "t", None),
                                                  ("https://a.example/1", None, "4"), ("", "t", "9")}
    last = keep_first(df, ["url", "title"], ["at"], last=True)
    assert {tuple(r) for r in last.collect()} == {("https://a.example/1", "t", "2"), (None, "t", "3"),
                                                  ("https://a.example/1", None, "5"), ("", "t", "9")}


def test_news_parses_a_date_once_to_filter(spark):
    rows = [("a", None, "Acme", "Pune", "1,200", "layoff", "Fri, 05 Jan 2024 10:11:12 GMT", "u1", "s", "rss", "1"),
            ("b", None, "Acme", "Pune", None, "hiring", "2024-01-20T00:00:00Z", "u2", "s", "api", "1"),
            ("c", None, "Acme", "Pune", "x", "hiring", "Fri, soon", "u3", "s", "rss", "1"),
            ("d", None, "Acme", "Pune", "9", "hiring", None, "u4", "s", "rss", "1"),
            ("e", None, "Acme", "Pune", "9000", "hiring", "2023-01-20", "u5", "s", "rss", "1")]
    out = silver.news(spark.createDataFrame(rows, NEWS), silver.Dictionaries(), F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    filters = [x for x in plan(out).splitlines() if "Filter" in x and "yyyy" in x]
    assert filters and all(x.count("M/d/yyyy") == 1 for x in filters)
    assert {(r.title, r.headcount, r.score_tenths, r.signal_score) for r in out.collect()} == {
        ("a", 1200, -8, -0.8), ("b", None, 4, 0.4)}


def test_weekday_text_is_tried_in_its_own_forms_only(spark):
    forms = ["Fri, 05 Jan 2024 10:11:12 GMT", "Fri, 05 Jan 2024 10:11:12 +0530", " fri, 05 Jan 2024 10:11:12 GMT ", "Fri, 2024-01-05",
             "2024-01-05", "2024-01-05T10:11:12Z", "1/5/2024", "05 Jan 2024 10:11:12 GMT", "", None]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, s string")
    parsed = df.select("i", F.date_format(parse_published("s"), "yyyy-MM-dd HH:mm").alias("t"))
    first = plan(df.select(parse_published("s").alias("t"))).split("Project [", 1)[1]
    assert first.startswith("CASE WHEN")
    assert [r.t for r in parsed.orderBy("i").collect()] == [
        "2024-01-05 10:11", "2024-01-05 04:41", "2024-01-05 10:11", None, "2024-01-05 00:00", "2024-01-05 10:11",
        "2024-01-05 00:00", None, None, None]


def test_score_of_a_read_count(spark):
    counts = [None, -5, 0, 100, 101, 1000, 1001, 5000, 5001, 2**62]
    df = spark.createDataFrame([(t, c) for t in ("layoff", "hiring", "neutral", None) for c in counts], "t string, c long")
    got = df.select((tenths_of_count("t", "c") / 10.0).alias("new"), signal_score("t", "c").alias("old")).collect()
    assert all(r.new == r.old for r in got)


def test_tables_with_one_consumer_are_not_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(core, "materialise", lambda df, name: written.append(name) or df)
    core.gold_company(spark, "/root/testdata/sf0.001", with_titles=False)
    assert written == ["silver-register"]
