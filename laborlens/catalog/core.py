"""Registered queries: silver and gold over the generated tables.

Each query is a ``(spark, sf_dir) -> DataFrame`` plan plus a DuckDB SQL twin.
Outputs are presentation-stable: doubles rounded to 6 places where they are
means, arrays joined to strings, dates as ISO strings.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlens.catalog import roles_sql as R
from laborlens.catalog import sqlgen as S
from laborlens.catalog.registry import register
from laborlens.functions import dictionaries as D
from laborlens.plans import gold, silver
from laborlens.session import materialise
from laborlens.sources import tables

NEWS_AS_OF = "2024-02-10 00:00:00"   # 30-day window starts 2024-01-11 (the events span January)
JOBS_AS_OF = "2001-08-01 00:00:00"
RECENT_DAYS = 365
TITLE_SEP = " || "


@lru_cache(maxsize=1)
def dic() -> silver.Dictionaries:
    return silver.fixture_dictionaries()


def ts(s: str):
    return F.to_timestamp(F.lit(s))


# ---------------------------------------------------------------- Spark side

def bronze_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    api = silver.register_from_api(tables.register_api_raw(spark, sf_dir), dic())
    seed = tables.register_seed(spark, sf_dir)
    both = api.select(*R.REGISTER_COLUMNS).unionByName(seed, allowMissingColumns=True)
    return both.select(*R.REGISTER_COLUMNS)


def silver_jobs(spark, sf_dir) -> DataFrame:
    return silver.jobs(tables.job_postings(spark, sf_dir), dic())


def silver_news(spark, sf_dir) -> DataFrame:
    return silver.news(tables.news_signals(spark, sf_dir), dic(), ts(NEWS_AS_OF))


def silver_register(spark, sf_dir) -> DataFrame:
    return silver.register(bronze_register(spark, sf_dir), dic())


def gold_company(spark, sf_dir, with_titles=True, news=None) -> DataFrame:
    """Company table; a silver table with several consumers is written once and read by all
    (``news``: silver news that the caller has written). One with a single consumer is not
    written: only the columns that it reads are computed, beside the other tables."""
    recent = silver.recent_jobs(silver_jobs(spark, sf_dir), ts(JOBS_AS_OF), RECENT_DAYS)
    if news is None:
        news = silver_news(spark, sf_dir)
        if with_titles:  # the titles read it again
            news = materialise(news, "silver-news")
    return gold.company(recent, news, materialise(silver_register(spark, sf_dir), "silver-register"),
                        it_sector=dic().it_sector, sectors=dic().sectors, with_titles=with_titles)


# ---------------------------------------------------------------- SQL side

def sql_recent_jobs() -> str:
    return (f"SELECT * FROM ({R.silver_jobs(dic())}) "
            f"WHERE posted_date >= CAST(TIMESTAMP '{JOBS_AS_OF}' AS DATE) - INTERVAL {RECENT_DAYS} DAY")


def sql_company_hiring() -> str:
    return (f"SELECT company_norm, city, count(*) AS open_positions, count(DISTINCT title) AS distinct_roles, "
            f"max(posted_date) AS latest_posting FROM ({sql_recent_jobs()}) GROUP BY company_norm, city")


def sql_company_news(news_sql: str | None = None) -> str:
    src = news_sql or R.silver_news(dic(), NEWS_AS_OF)
    return f"""
SELECT company_norm, city,
       CAST(sum(CASE WHEN signal_type = 'layoff' THEN coalesce(headcount, 0) ELSE 0 END) AS BIGINT) AS total_layoffs,
       CAST(sum(CASE WHEN signal_type = 'hiring' THEN coalesce(headcount, 0) ELSE 0 END) AS BIGINT) AS news_hires,
       CAST(sum(score_tenths) AS BIGINT) AS score_tenths, count(*) AS articles,
       CAST(count_if(signal_type = 'layoff') AS BIGINT) AS layoff_articles, CAST(count_if(signal_type = 'hiring') AS BIGINT) AS hiring_articles,
       {S.mean_score('sum(score_tenths)', 'count(*)')} AS avg_sentiment
FROM ({src}) GROUP BY company_norm, city"""


def sql_news_titles(k: int = 3, news_sql: str | None = None) -> str:
    src = news_sql or R.silver_news(dic(), NEWS_AS_OF)
    per_title = f"""
SELECT company_norm, city, title, o0, o1 FROM (
  SELECT company_norm, city, title, -epoch_us(published_ts) AS o0, url AS o1,
         row_number() OVER (PARTITION BY company_norm, city, title
                            ORDER BY -epoch_us(published_ts) ASC NULLS FIRST, url ASC NULLS FIRST) AS _r
  FROM ({src}) WHERE title IS NOT NULL) WHERE _r = 1"""
    ranked = f"""
SELECT *, row_number() OVER (PARTITION BY company_norm, city ORDER BY o0 ASC NULLS FIRST, o1 ASC NULLS FIRST, title) AS _k
FROM ({per_title})"""
    return (f"SELECT company_norm, city, list(title ORDER BY o0 ASC NULLS FIRST, o1 ASC NULLS FIRST, title) AS news_titles "
            f"FROM ({ranked}) WHERE _k <= {k} GROUP BY company_norm, city")


def sql_gold_company(with_titles=True) -> str:
    d = dic()
    titles_join = f"LEFT JOIN ({sql_news_titles(news_sql='SELECT * FROM _news')}) t USING (company_norm, city)" if with_titles else ""
    titles_col = ", t.news_titles" if with_titles else ""
    news = f"SELECT n.*{titles_col} FROM ({sql_company_news('SELECT * FROM _news')}) n {titles_join}"
    reg = "SELECT name_norm AS company_norm, city, sector AS reg_sector, status AS reg_status FROM _reg"
    by_name = "SELECT name_norm AS company_norm, sector AS name_sector FROM _reg"
    joined = f"""
SELECT * FROM ({sql_company_hiring()}) h FULL JOIN ({news}) n USING (company_norm, city)
FULL JOIN ({reg}) r USING (company_norm, city)"""
    filled = f"""
WITH _news AS MATERIALIZED ({R.silver_news(d, NEWS_AS_OF)}), _reg AS MATERIALIZED ({R.silver_register(d)})
SELECT j.company_norm, j.city, coalesce(open_positions, 0) AS open_positions, distinct_roles, latest_posting,
       coalesce(total_layoffs, 0) AS total_layoffs, coalesce(news_hires, 0) AS news_hires,
       coalesce(score_tenths, 0) AS score_tenths, coalesce(articles, 0) AS articles,
       coalesce(avg_sentiment, 0.0) AS avg_sentiment,
       coalesce(layoff_articles, 0) AS layoff_articles, coalesce(hiring_articles, 0) AS hiring_articles,
       {S.choose_sector('coalesce(reg_sector, b.name_sector)', 'j.company_norm', d.sectors)} AS sector,
       {S.company_status('coalesce(score_tenths, 0)', 'coalesce(articles, 0)', 'coalesce(layoff_articles, 0)', 'coalesce(hiring_articles, 0)')} AS company_status,
       reg_status{(", coalesce(news_titles, []) AS news_titles" if with_titles else "")}
FROM ({joined}) j LEFT JOIN ({by_name}) b ON j.company_norm = b.company_norm
WHERE length(j.company_norm) > 1"""
    return filled


# ---------------------------------------------------------------- queries


def _company_out(df: DataFrame) -> DataFrame:
    return df.select(
        "company_norm", "city", "open_positions", "distinct_roles",
        F.date_format("latest_posting", "yyyy-MM-dd").alias("latest_posting"),
        "total_layoffs", "news_hires", "layoff_articles", "hiring_articles",
        F.round("avg_sentiment", 6).alias("avg_sentiment"), "sector", "company_status",
        F.array_join("news_titles", TITLE_SEP).alias("news_titles"))


@register("gold_company", sql=lambda: f"""
SELECT company_norm, city, open_positions, distinct_roles, strftime(latest_posting, '%Y-%m-%d') AS latest_posting,
       total_layoffs, news_hires, layoff_articles, hiring_articles, round(avg_sentiment, 6) AS avg_sentiment,
       sector, company_status, array_to_string(news_titles, '{TITLE_SEP}') AS news_titles
FROM ({sql_gold_company()})""", ops="J3 G1 G2 G3 B12 Y5 Y6 Y7 X1 X2 U1 U2 U3 B4 B5 B6 B7 Y2 Y4 T3")
def q_gold_company(spark, sf_dir):
    return _company_out(gold_company(spark, sf_dir))


def city_rollup(spark, sf_dir, companies: DataFrame | None = None) -> DataFrame:
    companies = gold_company(spark, sf_dir, with_titles=False) if companies is None else companies
    g = gold.city(companies, dic().it_sector)
    coords = [(c, lat, lng) for c, lat, lng in D.CITY_COORDS]
    lat = F.lit(D.DEFAULT_COORDS[0])
    lng = F.lit(D.DEFAULT_COORDS[1])
    for c, la, ln in reversed(coords):
        lat = F.when(F.col("city") == c, F.lit(la)).otherwise(lat)
        lng = F.when(F.col("city") == c, F.lit(ln)).otherwise(lng)
    return g.select("city", lat.alias("lat"), lng.alias("lng"), "total_hiring", "total_layoffs", "total_companies",
                    "it_companies", "hiring_companies", "layoff_companies",
                    F.round("avg_sentiment", 6).alias("avg_sentiment"), "growth_score",
                    F.array_join("sectors", ",").alias("sectors"))


def sql_city_rollup() -> str:
    lat = "CASE " + " ".join(f"WHEN city = {S.q(c)} THEN CAST({la} AS DOUBLE)" for c, la, _ in D.CITY_COORDS) + f" ELSE CAST({D.DEFAULT_COORDS[0]} AS DOUBLE) END"
    lng = "CASE " + " ".join(f"WHEN city = {S.q(c)} THEN CAST({ln} AS DOUBLE)" for c, _, ln in D.CITY_COORDS) + f" ELSE CAST({D.DEFAULT_COORDS[1]} AS DOUBLE) END"
    agg = f"""
SELECT city, CAST(sum(open_positions) AS BIGINT) AS total_hiring, CAST(sum(total_layoffs) AS BIGINT) AS total_layoffs,
       count(company_norm) AS total_companies, avg(avg_sentiment) AS avg_sentiment,
       CAST(count_if(company_status = 'hiring') AS BIGINT) AS hiring_companies, CAST(count_if(company_status = 'layoff') AS BIGINT) AS layoff_companies,
       CAST(count_if(sector = {S.q(dic().it_sector)}) AS BIGINT) AS it_companies, list_sort(list_distinct(list(sector))) AS sectors
FROM ({sql_gold_company(with_titles=False)}) GROUP BY city"""
    return f"""
SELECT city, {lat} AS lat, {lng} AS lng, total_hiring, total_layoffs, total_companies, it_companies,
       hiring_companies, layoff_companies, round(avg_sentiment, 6) AS avg_sentiment,
       round((total_hiring - total_layoffs) / greatest(total_companies, 1), 2) AS growth_score,
       array_to_string(sectors, ',') AS sectors
FROM ({agg})"""


@register("gold_city_summary", sql=sql_city_rollup, ops="G4 G5 G6 J4 K9 X2")
def q_gold_city(spark, sf_dir):
    return city_rollup(spark, sf_dir)


@register("gold_sector", sql=lambda: f"""
SELECT sector, CAST(sum(open_positions) AS BIGINT) AS total_hiring, CAST(sum(total_layoffs) AS BIGINT) AS total_layoffs,
       count(company_norm) AS total_companies
FROM ({sql_gold_company(with_titles=False)}) GROUP BY sector ORDER BY total_hiring DESC, sector""", ops="G7 V4 K7")
def q_gold_sector(spark, sf_dir):
    return gold.sector(gold_company(spark, sf_dir, with_titles=False))


@register("silver_jobs", sql=lambda: f"""
SELECT company_norm, city, title, posted_date::VARCHAR AS posted_date, job_url, source, scraped_at
FROM ({R.silver_jobs(dic())})""", ops="A2 B1 B4 B13 T1 U1 X1 J7 X2 Y2")
def q_silver_jobs(spark, sf_dir):
    s = silver_jobs(spark, sf_dir)
    return s.select("company_norm", "city", "title", F.date_format("posted_date", "yyyy-MM-dd").alias("posted_date"),
                    "job_url", "source", "scraped_at")


@register("silver_news", sql=lambda: f"""
SELECT url_key, company_norm, city, title, signal_type, headcount, strftime(published_ts, '%Y-%m-%d %H:%M:%S') AS published_ts,
       signal_score, url, scraped_at
FROM ({R.silver_news(dic(), NEWS_AS_OF)})""", ops="U2 U4 B5 B6 Y2 Y3 Y4 X1 X2")
def q_silver_news(spark, sf_dir):
    s = silver_news(spark, sf_dir)
    return s.select("url_key", "company_norm", "city", "title", "signal_type", "headcount",
                    F.date_format("published_ts", "yyyy-MM-dd HH:mm:ss").alias("published_ts"),
                    "signal_score", "url", "scraped_at")


@register("silver_register", sql=lambda: f"""
SELECT name_norm, name, city, state, sector, status, cin, cin_prefix, roc, source
FROM ({R.silver_register(dic())})""", ops="U3 T3 B2 J5 X4 X1 J7 X2 X11")
def q_silver_register(spark, sf_dir):
    s = silver_register(spark, sf_dir)
    return s.select("name_norm", "name", "city", "state", "sector", "status", "cin", "cin_prefix", "roc", "source")


@register("company_news_signals", sql=lambda: f"""
SELECT company_norm, city, total_layoffs, news_hires, layoff_articles, hiring_articles, articles,
       round(avg_sentiment, 6) AS avg_sentiment,
       {S.status_from_sums('score_tenths', 'articles')} AS sentiment_status
FROM ({sql_company_news()})""", ops="G2 Y4 Y5")
def q_company_news(spark, sf_dir):
    from laborlens.functions.scoring import status_from_sums
    n = gold.company_news(silver_news(spark, sf_dir))
    return n.select("company_norm", "city", "total_layoffs", "news_hires", "layoff_articles", "hiring_articles",
                    "articles", F.round("avg_sentiment", 6).alias("avg_sentiment"),
                    status_from_sums("score_tenths", "articles").alias("sentiment_status"))


@register("company_hiring", sql=lambda: f"""
SELECT company_norm, city, open_positions, distinct_roles, strftime(latest_posting, '%Y-%m-%d') AS latest_posting
FROM ({sql_company_hiring()})""", ops="G1 B7")
def q_company_hiring(spark, sf_dir):
    recent = silver.recent_jobs(silver_jobs(spark, sf_dir), ts(JOBS_AS_OF), RECENT_DAYS)
    h = gold.company_hiring(recent)
    return h.select("company_norm", "city", "open_positions", "distinct_roles",
                    F.date_format("latest_posting", "yyyy-MM-dd").alias("latest_posting"))


@register("company_top_headlines", sql=lambda: f"""
SELECT company_norm, city, array_to_string(news_titles, '{TITLE_SEP}') AS news_titles, len(news_titles) AS n_titles
FROM ({sql_news_titles()})""", ops="G3 V6 Y10")
def q_top_headlines(spark, sf_dir):
    t = gold.news_titles(silver_news(spark, sf_dir))
    return t.select("company_norm", "city", F.array_join("news_titles", TITLE_SEP).alias("news_titles"),
                    F.size("news_titles").cast("bigint").alias("n_titles"))


@register("jobs_left_news_register", sql=lambda: f"""
SELECT h.company_norm, h.city, h.open_positions, coalesce(n.total_layoffs, 0) AS total_layoffs,
       n.layoff_articles, n.hiring_articles, coalesce(r.sector, 'Technology') AS sector, r.cin,
       {S.status_from_sums('n.score_tenths', 'n.articles')} AS company_status
FROM ({sql_company_hiring()}) h
LEFT JOIN ({sql_company_news()}) n ON h.company_norm = n.company_norm AND h.city = n.city
LEFT JOIN (SELECT name_norm, sector, cin FROM ({R.silver_register(dic())})) r ON h.company_norm = r.name_norm""",
          ops="J1 J2")
def q_jobs_left_news(spark, sf_dir):
    recent = silver.recent_jobs(silver_jobs(spark, sf_dir), ts(JOBS_AS_OF), RECENT_DAYS)
    j = gold.jobs_left_news(recent, silver_news(spark, sf_dir), silver_register(spark, sf_dir))
    return j.select("company_norm", "city", "open_positions", "total_layoffs", "layoff_articles",
                    "hiring_articles", "sector", "cin", "company_status")


BOARDS = {"hiring": "total_hiring", "sentiment": "avg_sentiment"}


@register("city_leaderboard", sql=lambda: f"""
WITH c AS MATERIALIZED ({sql_city_rollup()})
SELECT 'hiring' AS board, row_number() OVER (ORDER BY total_hiring DESC, city) AS place, city, total_hiring, avg_sentiment FROM c
UNION ALL
SELECT 'sentiment', row_number() OVER (ORDER BY avg_sentiment DESC, city), city, total_hiring, avg_sentiment FROM c""", ops="V5 T1")
def q_city_leaderboard(spark, sf_dir):
    """V5: every city's place by total hiring and by mean sentiment (one row per city meets in the windows)."""
    c = materialise(city_rollup(spark, sf_dir), "cities")
    boards = [c.select(F.lit(board).alias("board"),
                       F.row_number().over(Window.orderBy(F.desc(by), "city")).cast("bigint").alias("place"),
                       "city", "total_hiring", "avg_sentiment") for board, by in BOARDS.items()]
    return boards[0].unionByName(boards[1])
