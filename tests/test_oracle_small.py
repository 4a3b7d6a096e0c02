"""Registered queries vs their DuckDB twins on the smallest generated tables."""

import duckdb
import pytest

from laborlens.catalog.registry import load_all

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()
QUICK = ["silver_news", "company_news_signals", "document_sector", "signal_classify", "headline_extract",
         "page_text", "relative_posting_date", "payroll_by_city", "register_chunks", "page_job_cards",
         "tracker_layoffs", "jsonld_postings", "gold_city_summary"]


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, con, name):
    e = load_all()[name]
    df = e.run(spark, SF)
    cols = df.columns
    got = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)
    res = con.execute(e.sql())
    dcols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", ["tracker_silver_news", "news_all_origins", "companies_all", "companies_document", "run_meta",
                                  "similarity_join_names", "dictionary_mentions"])
def test_further_queries_match_sql(spark, con, name):
    test_query_matches_sql(spark, con, name)


def test_tracker_rows_inside_the_window_stay(spark):
    """At sf0.01 some tracker rows lie in the news window: both sides keep the same ones."""
    other = duckdb.connect()
    for t in TABLES:
        other.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF.replace('0.001', '0.01')}/{t}.parquet')")
    e = load_all()["tracker_silver_news"]
    got = e.run(spark, SF.replace("0.001", "0.01")).where("source = 'tracker'").select("url_key", "title", "day").collect()
    want = other.execute(f"SELECT url_key, title, day FROM ({e.sql()}) WHERE source = 'tracker'").fetchall()
    assert want and sorted(map(tuple, got)) == sorted(want)


def test_date_forms_have_one_meaning_on_both_sides(spark, con):
    from laborlens.catalog import sqlgen as S
    from laborlens.functions.dates import parse_published
    forms = ["2024-01-15", "2024-01-15T10:00:00Z", "2024-01-15T10:00:00.5Z", "2024-01-15T10:00:00+05:30", "2024-01-15 10:00:00",
             " 2024-01-15T10:00:00Z ", "Fri, 05 Jan 2024 10:11:12 GMT", "Fri, 05 Jan 2024 10:11:12 +0530", "1/5/2024", "11/25/2024",
             "soon", "", None, "2024-13-45", "Fri, 99 Jan 2024 10:11:12 GMT"]
    df = spark.createDataFrame([(x,) for x in forms], "x string")
    got = {r.x: r.t for r in df.select("x", parse_published("x").cast("string").alias("t")).collect()}
    want = {x: con.execute(f"SELECT {S.parse_published('x')}::VARCHAR FROM (SELECT ?::VARCHAR AS x)", [x]).fetchone()[0] for x in forms}
    assert got == want and sum(v is not None for v in got.values()) == 10


def test_company_names_of_the_twin_equal_the_kernel(spark, con):
    from laborlens.catalog import sqlgen as S
    from laborlens.functions.similarity import with_company_norm
    names = ["Infosys Limited", "Mahindra Techs", "Cyient Limited", "tcs", "T", "", None, "  Wipro  Ltd ", "Quite Another Firm", "a b c d e"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.o for r in with_company_norm(df, "n", "o").collect()}
    con.execute("CREATE OR REPLACE TEMP TABLE some_names (n VARCHAR)")
    con.executemany("INSERT INTO some_names VALUES (?)", [[n] for n in names])
    assert got == dict(con.execute(S.company_names("SELECT n FROM some_names", "n", "o")).fetchall())


def test_tracker_rows_keep_their_own_date(spark, con):
    from laborlens.catalog.sources_sinks import tracker_news
    got = {r.company: r.published_at for r in tracker_news(spark, SF).collect()}
    want = dict(con.execute("SELECT s_name, strftime(DATE '2023-12-22' + CAST(s_suppkey % 40 AS INT), '%Y-%m-%d') FROM supplier").fetchall())
    assert len(set(got.values())) > 1 and got == {k: want[k] for k in got}


@pytest.mark.parametrize("name", ["stream_dedup_news", "stream_daily_signals", "stream_company_signals", "stream_history_upsert"])
def test_streams_match_sql(spark, con, name):
    test_query_matches_sql(spark, con, name)


def test_page_text_is_whole(spark, con):
    e, served = load_all()["page_text_whole"], load_all()["page_text"]
    got = {r.page_id: r.text for r in e.run(spark, SF).collect()}
    assert got == dict(con.execute(e.sql()).fetchall())
    rows = served.run(spark, SF).collect()
    assert any(r.n_chars > 500 for r in rows)
    assert all(len(got[r.page_id]) == r.n_chars and got[r.page_id].startswith(r.description.rstrip()) for r in rows)


def test_entry_contract(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() >= 0
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 30
