"""Registered query: the end-to-end batch run (plans/batch.run) on landed fixture bronze."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from laborlens.catalog.core import JOBS_AS_OF, NEWS_AS_OF, RECENT_DAYS, bronze_register, dic, sql_gold_company
from laborlens.catalog.registry import register
from laborlens.plans.batch import run
from laborlens.session import scratch_path
from laborlens.sinks.landing import land_envelopes
from laborlens.sources import tables

RUN_TS = "20240210T000000Z"
# one as_of for the whole run: the job-recency window is widened so that it
# starts where the catalog's job window starts (JOBS_AS_OF - RECENT_DAYS)
_JOB_WINDOW_START = dt.date.fromisoformat(JOBS_AS_OF[:10]) - dt.timedelta(days=RECENT_DAYS)
BATCH_RECENT_DAYS = (dt.date.fromisoformat(NEWS_AS_OF[:10]) - _JOB_WINDOW_START).days


def land_fixture_bronze(spark, sf_dir, root):
    jobs = tables.job_postings(spark, sf_dir)
    land_envelopes(jobs, root, {"source": F.col("source"), "city": F.col("city_key")}, "job_url", "jobs",
                   "job_count", RUN_TS, "2024-02-10T00:00:00Z")
    land_envelopes(tables.news_signals(spark, sf_dir), root, {"source": F.lit("news")}, "url", "records",
                   "record_count", RUN_TS, "2024-02-10T00:00:00Z")
    land_envelopes(bronze_register(spark, sf_dir), root, {"source": F.lit("register")}, "name", "records",
                   "record_count", RUN_TS, "2024-02-10T00:00:00Z")


@register("batch_run_companies", sql=lambda: f"""
SELECT company_norm AS name, city, sector, company_status AS status, open_positions AS hiring,
       total_layoffs AS layoffs, round(avg_sentiment, 3) AS sentiment,
       array_to_string(news_titles[1:3], ' || ') AS news_headlines, '5' AS trend, true AS is_new
FROM ({sql_gold_company()}) WHERE company_norm <> '' AND city <> ''""", ops="A1 A2 A3 K1 K3 K4 K5 K6 K7 K8 K10 V1 V2 J9")
def q_batch_run(spark, sf_dir):
    raw = scratch_path(spark, "batch-raw")
    land_fixture_bronze(spark, sf_dir, raw)
    out = run(spark, raw, scratch_path(spark, "batch-out"), NEWS_AS_OF, RUN_TS,
              history_root=scratch_path(spark, "batch-history"), dic=dic(), recent_days=BATCH_RECENT_DAYS)
    c = out["companies_all"]
    return c.select("name", "city", "sector", "status", "hiring", "layoffs", "sentiment",
                    F.array_join("news_headlines", " || ").alias("news_headlines"),
                    F.array_join(F.col("trend").cast("array<string>"), ",").alias("trend"), "is_new")
