"""Column functions on literal rows: the edge cases of each operator."""

from pyspark.sql import functions as F

from laborlens.functions import dictionaries as D
from laborlens.functions import text as X
from laborlens.functions.dates import parse_published, relative_date
from laborlens.functions.scoring import company_status, signal_score, status_from_sums


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_title_case_matches_python_rule(spark):
    vals = ["byju's l&t", "nation_7", "hello WORLD", "abc1def", "", "éclair dü"]
    assert one_col(spark, vals, X.title_case) == [v.title() for v in vals]


def test_city_aliases_first_match_and_fallback(spark):
    vals = ["Bangalore Urban", "greater noida", "navi mumbai", "Navi-Mumbai West", "  springfield  ", None, ""]
    got = one_col(spark, vals, X.normalise_city)
    assert got == ["Bengaluru", "Noida", "Mumbai", "Mumbai", "Springfield", "", ""]


def test_fixture_alias_shadowing(spark):
    got = one_col(spark, ["NATION_1", "NATION_10", "NATION_19", "NATION_2"],
                  lambda c: X.normalise_city(c, D.fixture_city_aliases()))
    assert got == ["District 1", "District 1", "District 1", "District 2"]


def test_sector_classify_first_hit_and_traps(spark):
    vals = ["Infosys", "Reliance Industries", "Money matters", "Zzz"]
    assert one_col(spark, vals, lambda c: X.classify_sector(c)) == ["IT Services", "IT Services", "Consulting", "Other"]


def test_signal_classify_counts_words(spark):
    df = spark.createDataFrame([("Firm plans layoff and job cuts", ""), ("Hiring freshers on campus", "layoff"),
                                ("Nothing here", ""), ("layoff", "hiring")], "t string, d string")
    got = [r[0] for r in df.select(X.classify_signal("t", "d")).collect()]
    assert got == ["layoff", "hiring", "neutral", "neutral"]


def test_headcount_patterns_in_order(spark):
    vals = ["1,200 employees laid off at X", "plans to lay off 350 workers", "cut 100 to 200 jobs",
            "will reduce workforce by 2,500", "10% of its workforce", "no numbers", None]
    assert one_col(spark, vals, X.extract_headcount) == [1200, 350, 100, 2500, 10, None, None]


def test_company_extract_known_then_patterns_with_stop_list(spark):
    vals = ["Big news: infosys hires", "Acme Corp lays off 200", "The lays off story; Beta Labs fires 3",
            "India announces hiring", "nothing"]
    assert one_col(spark, vals, X.extract_company) == ["Infosys", "Acme Corp", "Beta Labs", "", ""]


def test_city_mention_earliest_then_longest(spark):
    vals = ["Offices in Pune and Mumbai", "new delhi office", "none", None]
    assert one_col(spark, vals, X.extract_city) == ["Pune", "New Delhi", "", ""]


def test_strip_html_and_host_and_slug(spark):
    df = spark.createDataFrame([("<p>Hi <b>there</b></p>", "https://a.example.com/x/y", "Navi Mumbai/West")],
                               "h string, u string, c string")
    r = df.select(X.strip_html("h"), X.url_host("u"), X.slug("c"), X.slug(F.lit(None).cast("string"))).first()
    assert tuple(r) == ("Hi  there", "a.example.com", "navi_mumbai_west", "unknown")


def test_first_nonempty_and_first_int(spark):
    df = spark.createDataFrame([("", "x", "1,234", "7"), (None, None, "abc", " 42 ")], "a string, b string, c string, d string")
    got = [tuple(r) for r in df.select(X.first_nonempty("a", "b"), X.first_int("c", "d")).collect()]
    assert got == [("x", 1234), (None, 42)]


def test_relative_dates(spark):
    as_of = F.to_timestamp(F.lit("2024-03-10 06:00:00"))
    vals = ["3 days ago", "30+ days ago", "2 weeks", "1 month", "Today", "", "7 hours ago", None]
    got = one_col(spark, vals, lambda c: relative_date(c, as_of))
    assert got == ["2024-03-07", "30+ days ago", "2024-02-25", "2024-02-09", "Today", "", "2024-03-09", ""]


def test_published_dates(spark):
    vals = ["2024-01-05T10:11:12Z", "Fri, 05 Jan 2024 10:11:12 GMT", "Fri, 05 Jan 2024 15:41:12 +0530", "garbage", None]
    got = one_col(spark, vals, lambda c: F.date_format(parse_published(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2024-01-05 10:11:12", "2024-01-05 10:11:12", "2024-01-05 10:11:12", None, None]


def test_signal_score_bands(spark):
    df = spark.createDataFrame([("layoff", 100), ("layoff", 101), ("hiring", 1000), ("hiring", 1001),
                                ("layoff", 5000), ("layoff", 5001), ("hiring", None), ("other", 9999)],
                               "t string, h long")
    got = [r[0] for r in df.select(signal_score("t", "h")).collect()]
    assert got == [-0.4, -0.6, 0.6, 0.8, -0.8, -1.0, 0.4, 0.0]


def test_status_thresholds_and_override(spark):
    # tenths sums: mean -0.3 is not < -0.3; mean 0.3 not > 0.3; no articles -> mixed
    df = spark.createDataFrame([(-6, 2, 0, 0), (6, 2, 0, 0), (-7, 2, 0, 0), (None, None, 0, 0),
                                (0, 3, 2, 1), (0, 4, 3, 1), (10, 1, 1, 0)], "s long, n long, l long, h long")
    got = [tuple(r) for r in df.select(status_from_sums("s", "n"), company_status("s", "n", "l", "h")).collect()]
    assert got == [("mixed", "mixed"), ("mixed", "mixed"), ("layoff", "layoff"), ("mixed", "mixed"),
                   ("mixed", "mixed"), ("mixed", "layoff"), ("hiring", "layoff")]
