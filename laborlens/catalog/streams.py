"""Registered queries: Structured Streaming jobs (Z1-Z4), run to completion.

News records are landed as envelope files (K1), then each job streams them
with ``availableNow`` into files under the shared checkpoint folder; the
query returns the batch read of the job's output.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from laborlens.catalog import roles_sql as R
from laborlens.catalog import sqlgen as S
from laborlens.catalog.core import dic
from laborlens.catalog.registry import register
from laborlens.catalog.sources_sinks import BATCH_TS, RUN_TS
from laborlens.functions import dictionaries as D
from laborlens.operators import history as H
from laborlens.session import scratch_path
from laborlens.sinks.landing import land_envelopes
from laborlens.sources import tables
from laborlens.streaming import incremental as Z


def _landed_news(spark, sf_dir):
    root = scratch_path(spark, "stream-landed")
    news = tables.news_signals(spark, sf_dir)
    land_envelopes(news, root, {"source": F.lit("news"), "city": F.coalesce(F.col("city"), F.lit("none"))},
                   "url", "records", "record_count", RUN_TS, BATCH_TS, max_records=200)
    return root


def _silver_stream(spark, sf_dir):
    d = dic()
    root = _landed_news(spark, sf_dir)
    Z.keep_unreadable(spark, root, scratch_path(spark, "stream-unreadable"), scratch_path(spark, "stream-unreadable-ck"))
    return Z.silver_news_stream(Z.news_stream(spark, root), d.canonical, d.city_aliases)


def _sql_news_parsed(more: str = "") -> str:
    with_norm = R.company_map(R.NEWS, "company", "company_norm", dic())
    return f"""
SELECT *, {S.news_url_key('url', 'title', 'company')} AS url_key FROM (
  SELECT company_norm, {S.normalise_city('city', dic().city_aliases)} AS city, signal_type, headcount, url, title, company{more},
         {S.parse_published('published_at')} AS published_ts,
         {S.signal_score_tenths('signal_type', 'headcount')} AS score_tenths
  FROM ({with_norm}))
WHERE signal_type IN ('layoff', 'hiring', 'neutral') AND published_ts IS NOT NULL"""


@register("stream_dedup_news", sql=lambda: f"""
SELECT DISTINCT url_key, company_norm, city, signal_type, strftime(published_ts, '%Y-%m-%d') AS day
FROM ({_sql_news_parsed()})""", ops="Z1 Z2 A1 A2 K1")
def q_stream_dedup(spark, sf_dir):
    out, ck = scratch_path(spark, "z12-out"), scratch_path(spark, "z12-ck")
    Z.run_to_parquet(Z.dedupe_stream(_silver_stream(spark, sf_dir)), out, ck)
    return spark.read.parquet(out).select("url_key", "company_norm", "city", "signal_type",
                                          F.date_format("published_ts", "yyyy-MM-dd").alias("day"))


@register("stream_daily_signals", sql=lambda: f"""
SELECT strftime(date_trunc('day', published_ts), '%Y-%m-%d') AS day, signal_type, count(*) AS articles,
       CAST(sum(score_tenths) AS BIGINT) AS score_tenths
FROM ({_sql_news_parsed()}) GROUP BY 1, 2""", ops="Z3")
def q_stream_daily(spark, sf_dir):
    return (_daily(spark, sf_dir).groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "signal_type")
            .agg(F.sum("articles").alias("articles"), F.sum("score_tenths").alias("score_tenths")))


@register("stream_company_signals", sql=lambda: f"""
SELECT company_norm, strftime(date_trunc('day', published_ts), '%Y-%m-%d') AS day, signal_type, count(*) AS articles,
       CAST(sum(score_tenths) AS BIGINT) AS score_tenths
FROM ({_sql_news_parsed()}) GROUP BY 1, 2, 3""", ops="Z3")
def q_stream_company(spark, sf_dir):
    return _daily(spark, sf_dir).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def _daily(spark, sf_dir):
    out, ck = scratch_path(spark, "z3-out"), scratch_path(spark, "z3-ck")
    Z.daily_signals(_silver_stream(spark, sf_dir), out, ck)
    return Z.read_daily_signals(spark, out)


def _sql_stream_history() -> str:
    hc = "coalesce(headcount, 0)"
    daily = (f"SELECT company_norm AS company, city, strftime(published_ts, '%Y-%m-%d') AS date, "
             f"CAST(sum(CASE WHEN signal_type = 'hiring' THEN {hc} ELSE 0 END) AS BIGINT) AS hiring, "
             f"CAST(sum(CASE WHEN signal_type = 'layoff' THEN {hc} ELSE 0 END) AS BIGINT) AS layoffs "
             f"FROM ({_sql_news_parsed()}) GROUP BY 1, 2, 3")
    last = (f"SELECT *, hiring - layoffs AS score FROM (SELECT *, row_number() OVER (PARTITION BY company, city ORDER BY date DESC) AS _rn "
            f"FROM ({daily})) WHERE _rn <= {D.HISTORY_POINTS}")
    scaled = (f"SELECT company, city, date, greatest({D.TREND_MIN}, least({D.TREND_MAX}, "
              f"CAST(floor((score - mn) / (CASE WHEN mx - mn = 0 THEN 1 ELSE mx - mn END) * {D.TREND_SPAN}) AS INT) + {D.TREND_MIN})) AS t "
              f"FROM (SELECT *, min(score) OVER (PARTITION BY company, city) AS mn, max(score) OVER (PARTITION BY company, city) AS mx FROM ({last}))")
    return (f"SELECT company, city, array_to_string(list(t ORDER BY date), ',') AS trend, count(*) AS n_points, "
            f"max(date) AS last_date FROM ({scaled}) GROUP BY 1, 2")


@register("stream_history_upsert", sql=_sql_stream_history, ops="Z4 V1 V2 K10")
def q_stream_history(spark, sf_dir):
    state, ck = scratch_path(spark, "z4-state"), scratch_path(spark, "z4-ck")
    Z.history_upsert(_silver_stream(spark, sf_dir), state, ck)
    hist = Z.read_history(spark, state)
    tr = H.trend(hist)
    meta = hist.groupBy("company", "city").agg(F.count(F.lit(1)).alias("n_points"), F.max("date").alias("last_date"))
    return tr.join(meta, ["company", "city"]).select(
        "company", "city", F.array_join(F.col("trend").cast("array<string>"), ",").alias("trend"), "n_points", "last_date")


@register("stream_earliest_news", sql=lambda: f"""
SELECT url_key, title, company_norm, city, signal_type, scraped_at FROM (
  SELECT *, row_number() OVER (PARTITION BY url_key ORDER BY scraped_at NULLS FIRST, published_ts, title NULLS FIRST) AS _r
  FROM ({_sql_news_parsed(", scraped_at")})) WHERE _r = 1""", ops="Z1 Z2 U2")
def q_stream_earliest(spark, sf_dir):
    """Z2 with U2's row: the copy of each URL that was scraped first, kept in keyed state;
    all landed rows take part, in whatever order their files are read."""
    silver = _silver_stream(spark, sf_dir)
    out = scratch_path(spark, "z2-earliest")
    Z.run_earliest(silver, out, scratch_path(spark, "z2-earliest-ck"), keep_days=None)
    return Z.read_earliest(spark, out, silver.schema).select("url_key", "title", "company_norm", "city", "signal_type", "scraped_at")


@register("stream_windowed_signals", sql=lambda: f"""
SELECT strftime(date_trunc('day', published_ts), '%Y-%m-%d') AS day, company_norm, signal_type, count(*) AS articles,
       CAST(sum(score_tenths) AS BIGINT) AS score_tenths
FROM ({_sql_news_parsed()}) GROUP BY 1, 2, 3""", ops="Z3")
def q_stream_windows(spark, sf_dir):
    """Z3 as event-time windows in update mode with an idempotent sink."""
    out = scratch_path(spark, "z3-windows")
    Z.windowed_signals(_silver_stream(spark, sf_dir), out, scratch_path(spark, "z3-windows-ck"))
    return Z.read_windows(spark, out).select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "company_norm",
                                             "signal_type", "articles", "score_tenths")
