"""End-to-end batch run over landed bronze: the user-facing entry point.

    outputs = run(spark, raw_root, out_root, as_of="2024-01-31 06:00:00", run_ts="r42",
                  history_root=".../history")

reads every landed run of each source (A1-A3), builds silver (normalise,
parse, score, dedupe), gold (company x city, city, sector), updates the
company history to a new version directory (V1, K10) and writes the served
documents (K4-K8) under ``out_root``. Returns the DataFrames by name. Source
prefixes are parameters (the landed ``source=<prefix>`` directories);
``run_ts`` names the history version and must sort in run order (for
example ``20240131T060000Z``).

Each layer is written as a table and read back before the next layer uses
it: every stage is computed once even though several outputs share it, and
the lineage is cut at durable files in the shared output folder, so a lost
executor only costs the current stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens import schemas
from laborlens.functions import dictionaries as D
from laborlens.operators import history as H
from laborlens.plans import gold, silver
from laborlens.sinks import documents as K
from laborlens.sinks.landing import write_table
from laborlens.sinks.snapshots import SnapshotTable
from laborlens.sources import bronze
from laborlens.streaming.incremental import latest_state


def run(spark: SparkSession, raw_root: str, out_root: str, as_of: str, run_ts: str,
        history_root: str | None = None, dic: silver.Dictionaries | None = None,
        job_sources: Sequence[str] = ("board_a", "board_b"), news_source: str = "news",
        register_source: str = "register", recent_days: int = 0, window_days: int = 30,
        multiline: bool | None = None, since: str | None = None, until: str | None = None) -> dict[str, DataFrame]:
    """See the module. ``since`` and ``until`` (ISO dates) restrict jobs and news to what
    landed on these days; the register is always read whole."""
    dic = dic or silver.Dictionaries()
    as_of_ts = F.to_timestamp(F.lit(as_of))
    today = as_of[:10]

    # bronze (every landed run; a missing source is an empty relation)
    job_parts = [bronze.load_source(spark, raw_root, s, schemas.JOB, multiline, since, until) for s in job_sources]
    jobs_bronze = job_parts[0]
    for p in job_parts[1:]:
        jobs_bronze = jobs_bronze.unionByName(p, allowMissingColumns=True)
    job_cols = [f.name for f in schemas.JOB.fields]
    news_bronze = bronze.load_source(spark, raw_root, news_source, schemas.NEWS, multiline, since, until)
    reg_bronze = bronze.load_source(spark, raw_root, register_source, schemas.REGISTER, multiline)

    def materialise(df: DataFrame, name: str) -> DataFrame:
        path = f"{out_root}/{name}"
        write_table(df, path)
        return spark.read.parquet(path)

    def publish(df: DataFrame, name: str) -> DataFrame:
        """K3: the next version of a gold table; readers see the one before until it is complete."""
        table = SnapshotTable(spark, f"{out_root}/{name}")
        table.overwrite(df, run_ts)
        return table.read(run_ts)

    # silver (written once, read back by every consumer)
    s_jobs = materialise(silver.jobs(jobs_bronze.select(*job_cols), dic), "silver_jobs")
    s_news = materialise(silver.news(news_bronze.select(*[f.name for f in schemas.NEWS.fields]), dic, as_of_ts,
                                     window_days), "silver_news")
    s_reg = materialise(silver.register(reg_bronze.select(*[f.name for f in schemas.REGISTER.fields]), dic),
                        "silver_register")

    # gold
    g_company = gold.company(silver.recent_jobs(s_jobs, as_of_ts, recent_days), s_news, s_reg,
                             it_sector=dic.it_sector, sectors=dic.sectors)
    g_company = publish(g_company.withColumns({"run_ts": F.lit(run_ts), "updated_at": F.lit(today)}),
                            "gold_companies")
    g_city = publish(gold.city(g_company, dic.it_sector), "gold_districts")
    g_sector = publish(gold.sector(g_company), "gold_sectors")

    # history: prior state -> new version; trend and is_new per company x city
    served = g_company.where((F.col("company_norm") != "") & (F.col("city") != ""))
    prior = latest_state(spark, history_root, before=run_ts) if history_root else spark.createDataFrame([], schemas.HISTORY)
    snap = H.snapshot_rows(served.withColumnRenamed("company_norm", "company"), F.to_date(F.lit(today)),
                           hiring="open_positions", layoffs="total_layoffs")
    new_state = H.update_history(prior, snap)
    if history_root:
        write_table(new_state, f"{history_root}/v={run_ts}")
        new_state = spark.read.schema(schemas.HISTORY).parquet(f"{history_root}/v={run_ts}")
    trend = H.trend(new_state)
    companies = (served.select(F.col("company_norm").alias("company"), "city", "sector",
                               F.col("company_status").alias("status"), F.col("open_positions").alias("hiring"),
                               F.col("total_layoffs").alias("layoffs"), F.round("avg_sentiment", 3).alias("sentiment"),
                               F.slice("news_titles", 1, 3).alias("news_headlines"), "updated_at", "run_ts")
                 .join(trend, ["company", "city"], "left"))
    companies = H.mark_new(companies, prior).withColumnRenamed("company", "name")
    companies = materialise(companies, "companies_served").orderBy(F.desc("is_new"), F.desc("hiring"), "name", "city")

    # served documents
    coords = spark.createDataFrame(list(D.CITY_COORDS), "city string, lat double, lng double")  # J4, code-sized
    located = (g_city.join(coords, "city", "left")
               .withColumns({"lat": F.coalesce("lat", F.lit(D.DEFAULT_COORDS[0])),
                             "lng": F.coalesce("lng", F.lit(D.DEFAULT_COORDS[1]))}))
    K.write_city_summary(located, f"{out_root}/city_summary", run_ts, today)
    K.write_lines_document(companies, f"{out_root}/companies_all", run_ts, today, new_flag="is_new")
    K.write_lines_document(g_sector, f"{out_root}/sectors", run_ts, today)
    K.write_city_pages(K.city_company_pages(g_company), f"{out_root}/companies_by_city")
    meta = K.run_meta(companies, g_city, run_ts, today, new_flag="is_new", name_col="name")
    meta.coalesce(1).write.mode("overwrite").json(f"{out_root}/meta")
    return {"silver_jobs": s_jobs, "silver_news": s_news, "silver_register": s_reg, "gold_company": g_company,
            "gold_city": located, "gold_sector": g_sector, "companies_all": companies, "history": new_state,
            "meta": meta, "news_dropped": silver.unparsed_news(news_bronze)}
