"""Dedupe, top-k, history/trend, payroll split, numbering, HTML, missing sources."""

from pyspark.sql import functions as F

from laborlens import schemas
from laborlens.operators.dedupe import fallback_key, keep_first
from laborlens.operators.history import mark_new, trend, update_history
from laborlens.operators.html import header_records
from laborlens.operators.numbering import chunk_records
from laborlens.operators.payroll import split_by_city
from laborlens.operators.topk import top_k_distinct
from laborlens.sources import bronze


def test_keep_first_is_deterministic(spark):
    data = [("a", "2024-01-02", "u2", 1), ("a", "2024-01-01", "u9", 2), ("a", "2024-01-01", "u3", 3), ("b", None, "u1", 4)]
    df = spark.createDataFrame(data, "k string, ts string, url string, v int")
    want = {("a", 3), ("b", 4)}
    for parts in (1, 3):
        got = {(r.k, r.v) for r in keep_first(df.repartition(parts), ["k"], ["ts", "url"]).collect()}
        assert got == want


def test_fallback_key(spark):
    df = spark.createDataFrame([("", "T", "C"), ("http://x", "T", "C"), (None, None, "C")], "u string, t string, c string")
    assert [r[0] for r in df.select(fallback_key("u", "t", "c")).collect()] == ["T|C", "http://x", "|C"]


def test_top_k_distinct_with_salt(spark):
    rows = [("g", f"t{i % 5}", 100 - i) for i in range(50)] + [("h", None, 1)]
    df = spark.createDataFrame(rows, "g string, t string, o int")
    out = top_k_distinct(df, ["g"], "t", [F.col("o")], 3, "top", salt_buckets=4).collect()
    # best (smallest) o per title: t4 -> 51, t3 -> 52, t2 -> 53
    assert [(r.g, r.top) for r in out] == [("g", ["t4", "t3", "t2"])]


def test_history_same_day_replace_and_eight_points(spark):
    state = spark.createDataFrame([("c", "x", f"2024-01-{d:02d}", d, 0, d) for d in range(1, 10)], schemas.HISTORY)
    snap = spark.createDataFrame([("c", "x", "2024-01-09", 100, 0, 100), ("n", "y", "2024-01-09", 5, 5, 0)], schemas.HISTORY)
    h = update_history(state, snap)
    got = sorted((r.company, r.date, r.score) for r in h.collect())
    assert len([g for g in got if g[0] == "c"]) == 8
    assert ("c", "2024-01-09", 100) in got and ("c", "2024-01-01", 1) not in got
    t = {r.company: r.trend for r in trend(h).collect()}
    assert t["n"] == [5] and t["c"][-1] == 100 and t["c"][0] == 5
    flags = {r.company: r.is_new for r in mark_new(snap, state).collect()}
    assert flags == {"c": False, "n": True}


def test_payroll_split_sums_back(spark):
    df = spark.createDataFrame([("S", 10), ("S", -7), ("Lonely", 5)], "state string, value long")
    cities = spark.createDataFrame([("S", ["a", "b", "c"])], "state string, cities array<string>")
    out = split_by_city(df, cities).collect()
    by = {}
    for r in out:
        by.setdefault((r.state, r.value), []).append((r.city, r.city_value))
    assert by[("S", 10)] == [("a", 4), ("b", 3), ("c", 3)]
    assert sorted(by[("S", -7)]) == [("a", -1), ("b", -3), ("c", -3)]
    assert by[("Lonely", 5)] == [("Lonely", 5)]


def test_chunk_records(spark):
    df = spark.range(1, 1203).withColumnRenamed("id", "k")
    out = chunk_records(df, "k", 500)
    got = {(r.chunk, r.record_count) for r in out.collect()}
    assert got == {(0, 500), (1, 500), (2, 202)}
    assert out.where("chunk = 2").agg(F.min("k")).first()[0] == 1001


def test_html_table_header_records(spark):
    html = ("<table><tr><th>State Name</th><th>Month</th></tr><tr><td>Kerala</td><td>2024-01</td></tr>"
            "<tr><td>bad</td></tr><tr><td>Goa</td><td> 2024-02 </td></tr></table>")
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    recs = header_records(df, "html", ["page_id"]).orderBy("row_idx").collect()
    assert [dict(r.rec) for r in recs] == [{"state_name": "Kerala", "month": "2024-01"},
                                            {"state_name": "Goa", "month": "2024-02"}]


def test_missing_source_keeps_schema(spark, tmp_path):
    df = bronze.load_source(spark, str(tmp_path), "nothing_here", schemas.JOB)
    assert df.count() == 0 and [f.name for f in schemas.JOB.fields] == df.columns[:len(schemas.JOB.fields)]


def test_page_postings_modes(spark):
    from laborlens.operators.html import page_postings
    ld = ('<script type="application/ld+json">[{"@type":"JobPosting","title":"T1","hiringOrganization":{"name":"C"},'
          '"url":"u1"},{"@type":"Organization","name":"x"}]</script>')
    cards = '<li><a href="/j2">T2</a></li>'
    df = spark.createDataFrame([(1, ld), (2, cards + ld), (3, cards)], "p int, html string")
    for mode, want in (("fallback", {1: ["T1"], 2: ["T2"], 3: ["T2"]}), ("both", {1: ["T1"], 2: ["T2", "T1"], 3: ["T2"]})):
        got = {r.p: [x.title for x in r.j] for r in df.select("p", page_postings(F.col("html"), F.lit("Co"), mode).alias("j")).collect()}
        assert got == want, mode


CARDS_A = """<ul><li><a href="/nav">nav</a></li></ul><h1>Page Co</h1>
<article class="jobTuple bgWhite"><div><a class="title fw500" href="/j1?a=1&amp;b=2">Data <b>Engineer</b></a>
<a class="subTitle" href="/c">Acme &amp; Sons</a></div><ul><li class="experience"><span>2-5 Yrs</span></li>
<li class="salary"><span>6 Lacs</span></li><li class="location"><i></i><span>Navi Mumbai</span></li></ul>
<div><div></div></div><span class="date">3 Days Ago</span></article>
<div class="x srp-jobtuple-wrapper"><div><a class="title " href="/j2">Tester</a><a class="comp-name mw" href="/b">Beta</a>
<span class="exp-wrap"><span>1 Yr</span></span><span class="job-post-day ">Just now</span></div></div>
<footer><span class="date">9 weeks ago</span><span class="salary">x</span></footer>"""
CARDS_B = """<ul><li><div class="base-card relative"><a class="base-card__full-link" href="/k1"></a>
<h3 class="base-search-card__title"> Analyst </h3><h4 class="base-search-card__subtitle"><a href="/g">Gamma</a></h4>
<span class="job-search-card__location">Pune, India</span><time datetime="2024-01-30">1 day ago</time></div></li>
<li class="result-card"><a class="result-card__full-card-link" href="/k2"></a><h3 class="result-card__title">Clerk</h3>
<h4 class="result-card__subtitle">Delta</h4></li></ul>"""


def test_board_cards_keep_every_field(spark):
    from laborlens.operators.html import page_postings
    ld = ('<script type="application/ld+json">{"@type":"JobPosting","title":"L","hiringOrganization":{"name":"C"},'
          '"datePosted":"2024-01-02","url":"/l"}</script>')
    df = spark.createDataFrame([(1, CARDS_A), (2, CARDS_B), (3, ld), (4, CARDS_B + ld), (5, None)], "p int, html string")
    postings = lambda mode: page_postings(F.col("html"), F.lit("Page Co"), mode, F.lit("new delhi"),
                                          F.lit("2024-01-31 06:00:00").cast("timestamp"))
    cols = ["title", "company", "location", "experience", "salary", "posted_date", "job_url"]
    got = lambda mode: {r.p: [tuple(x[c] for c in cols) for x in r.j or []]
                        for r in df.select("p", postings(mode).alias("j")).collect()}
    b = [("Analyst", "Gamma", "Pune, India", "", "", "2024-01-30", "/k1"),
         ("Clerk", "Delta", "New Delhi", "", "", "", "/k2")]
    one = ("L", "C", "New Delhi", "", None, "2024-01-02", "/l")
    want = {1: [("DataEngineer", "Acme & Sons", "Navi Mumbai", "2-5 Yrs", "6 Lacs", "2024-01-28", "/j1?a=1&b=2"),
                ("Tester", "Beta", "New Delhi", "1 Yr", "", "Just now", "/j2")], 2: b, 3: [one], 4: b, 5: []}
    assert got("fallback") == want
    assert got("both") == want | {4: b + [one]}
    assert df.select(F.explode(postings("fallback")).alias("x")).count() == 7


def test_unparsed_news_dates_are_counted(spark):
    from laborlens.plans import silver
    df = spark.createDataFrame([("layoff", "soon"), ("layoff", None), ("hiring", "2024-01-05"), ("other", "soon")],
                               "signal_type string, published_at string")
    assert silver.unparsed_news(df).first().unparsed_dates == 2


def test_news_url_key_root_urls(spark):
    from laborlens.operators.dedupe import news_url_key
    df = spark.createDataFrame([("https://t.example/", "A"), ("https://t.example", "B"), ("https://t.example/x/1", "C"),
                                ("", "D")], "u string, t string")
    got = [r[0] for r in df.select(news_url_key("u", "t", F.lit("Co"))).collect()]
    assert got == ["https://t.example/|A", "https://t.example|B", "https://t.example/x/1", "D|Co"]


def test_header_is_per_table(spark):
    html = ("<table><tr><th>State</th><th>Month</th></tr><tr><td>Goa</td><td>1</td></tr></table>"
            "<table><tr><th>Zone</th><th>Total</th></tr><tr><td>West</td><td>9</td></tr></table>")
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    recs = header_records(df, "html", ["page_id"]).orderBy("table_idx", "row_idx").collect()
    assert [dict(r.rec) for r in recs] == [{"state": "Goa", "month": "1"}, {"zone": "West", "total": "9"}]


def test_published_forms(spark):
    from laborlens.functions.dates import parse_iso_date, parse_published
    forms = {"2024-01-15": "2024-01-15 00:00:00", "2024-01-15T10:11:12+05:30": "2024-01-15 04:41:12",
             "2024-01-15T10:11:12.5Z": "2024-01-15 10:11:12", "1/15/2024": "2024-01-15 00:00:00",
             "Fri, 05 Jan 2024 10:11:12 GMT": "2024-01-05 10:11:12", "2024": None, "soon": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in forms], "s string")
    got = {r.s: r.t for r in df.select("s", F.date_format(parse_published("s"), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()}
    assert got == forms
    days = {r.s: r.d for r in df.select("s", F.date_format(parse_iso_date("s"), "yyyy-MM-dd").alias("d")).collect()}
    assert days == {k: v and v[:10] for k, v in forms.items()}


def test_counts_as_text_or_number(spark):
    from laborlens.functions.scoring import signal_score_tenths
    from laborlens.functions.text import parse_count, safe_float, safe_int
    df = spark.createDataFrame([("1,200",), ("5000.0",), (" 7 ",), ("NaN",), ("many",), (None,), ("5001",)], "h string")
    got = df.select(parse_count("h"), safe_int("h", -1), safe_float("h"), signal_score_tenths(F.lit("hiring"), "h")).collect()
    assert [r[0] for r in got] == [1200, 5000, 7, None, None, None, 5001]
    assert [r[1] for r in got] == [1200, 5000, 7, -1, -1, -1, 5001]
    assert [r[2] for r in got] == [1200.0, 5000.0, 7.0, 0.0, 0.0, 0.0, 5001.0]
    assert [r[3] for r in got] == [8, 8, 4, 4, 4, 4, 10]
    assert spark.range(1).select(safe_int(F.lit(float("nan")))).first()[0] == 0
