"""Registered queries: history and trend (V1-V3, J9, K6) and payroll."""

from __future__ import annotations

from pyspark.sql import functions as F

from laborlens.catalog import roles_sql as R
from laborlens.catalog import sqlgen as S
from laborlens.catalog.core import NEWS_AS_OF, dic, gold_company, silver_news, sql_gold_company
from laborlens.catalog.registry import register
from laborlens.functions import dictionaries as D
from laborlens.functions.text import first_int, first_nonempty, strip_ws, title_case
from laborlens.operators import history as H
from laborlens.operators.html import header_records
from laborlens.operators.payroll import split_by_city
from laborlens.session import materialise
from laborlens.sources import tables

SNAPSHOT_DATE = "2024-01-30"


def _daily(news, where=None):
    hc = F.coalesce("headcount", F.lit(0))
    src = news if where is None else news.where(where)
    return (src.groupBy(F.col("company_norm").alias("company"), "city",
                        F.date_format("published_ts", "yyyy-MM-dd").alias("date"))
            .agg(F.sum(F.when(F.col("signal_type") == "hiring", hc).otherwise(0)).cast("bigint").alias("hiring"),
                 F.sum(F.when(F.col("signal_type") == "layoff", hc).otherwise(0)).cast("bigint").alias("layoffs"))
            .withColumn("score", F.col("hiring") - F.col("layoffs")))


def prior_and_snapshot(spark, sf_dir, news=None):
    """Prior state: daily per-key entries from API-sourced news (earlier runs).
    Snapshot: per-key totals over all news, dated the last news day (a later
    run of that day, so it replaces that day's entry)."""
    news = materialise(silver_news(spark, sf_dir), "silver-news") if news is None else news
    prior = _daily(news, F.col("source") == "api")
    hc = F.coalesce("headcount", F.lit(0))
    snap = (news.groupBy(F.col("company_norm").alias("company"), "city")
            .agg(F.sum(F.when(F.col("signal_type") == "hiring", hc).otherwise(0)).cast("bigint").alias("hiring"),
                 F.sum(F.when(F.col("signal_type") == "layoff", hc).otherwise(0)).cast("bigint").alias("layoffs"))
            .select("company", "city", F.lit(SNAPSHOT_DATE).alias("date"), "hiring", "layoffs",
                    (F.col("hiring") - F.col("layoffs")).alias("score")))
    return prior, snap


def _sql_daily_and_snap():
    news = R.silver_news(dic(), NEWS_AS_OF)
    hc = "coalesce(headcount, 0)"
    hire = f"CAST(sum(CASE WHEN signal_type = 'hiring' THEN {hc} ELSE 0 END) AS BIGINT)"
    lay = f"CAST(sum(CASE WHEN signal_type = 'layoff' THEN {hc} ELSE 0 END) AS BIGINT)"
    prior = (f"SELECT company, city, date, hiring, layoffs, hiring - layoffs AS score FROM ("
             f"SELECT company_norm AS company, city, strftime(published_ts, '%Y-%m-%d') AS date, {hire} AS hiring, "
             f"{lay} AS layoffs FROM ({news}) WHERE source = 'api' GROUP BY 1, 2, 3)")
    snap = (f"SELECT company, city, '{SNAPSHOT_DATE}' AS date, hiring, layoffs, hiring - layoffs AS score FROM ("
            f"SELECT company_norm AS company, city, {hire} AS hiring, {lay} AS layoffs FROM ({news}) GROUP BY 1, 2)")
    return prior, snap


def _sql_history():
    prior, snap = _sql_daily_and_snap()
    both = f"SELECT *, 0 AS _prio FROM ({prior}) UNION ALL SELECT *, 1 AS _prio FROM ({snap})"
    one = (f"SELECT company, city, date, hiring, layoffs, score FROM (SELECT *, row_number() OVER (PARTITION BY company, city, date "
           f"ORDER BY _prio DESC, hiring DESC, layoffs DESC, score DESC) AS _r FROM ({both})) WHERE _r = 1")
    return (f"SELECT company, city, date, hiring, layoffs, score FROM (SELECT *, row_number() OVER (PARTITION BY company, city "
            f"ORDER BY date DESC) AS _rn FROM ({one})) WHERE _rn <= {D.HISTORY_POINTS}")


def _sql_trend():
    h = _sql_history()
    scaled = (f"SELECT company, city, date, greatest({D.TREND_MIN}, least({D.TREND_MAX}, "
              f"CAST(floor((score - mn) / (CASE WHEN mx - mn = 0 THEN 1 ELSE mx - mn END) * {D.TREND_SPAN}) AS INT) + {D.TREND_MIN})) AS t "
              f"FROM (SELECT *, min(score) OVER (PARTITION BY company, city) AS mn, max(score) OVER (PARTITION BY company, city) AS mx FROM ({h}))")
    return f"SELECT company, city, list(t ORDER BY date) AS trend, max(date) AS last_date, count(*) AS n_points FROM ({scaled}) GROUP BY 1, 2"


@register("company_trend", sql=lambda: f"""
SELECT t.company, t.city, array_to_string(t.trend, ',') AS trend, t.last_date, t.n_points,
       p.company IS NULL AS is_new
FROM ({_sql_trend()}) t
LEFT JOIN (SELECT DISTINCT company, city FROM ({_sql_daily_and_snap()[0]})) p ON t.company = p.company AND t.city = p.city""",
          ops="V1 V2 J9 K10 G10")
def q_company_trend(spark, sf_dir):
    prior, snap = prior_and_snapshot(spark, sf_dir)
    hist = H.update_history(prior, snap)
    tr = H.trend(hist)
    meta = hist.groupBy("company", "city").agg(F.max("date").alias("last_date"), F.count(F.lit(1)).alias("n_points"))
    flagged = H.mark_new(tr.join(meta, ["company", "city"]), prior)
    return flagged.select("company", "city", F.array_join(F.col("trend").cast("array<string>"), ",").alias("trend"),
                          "last_date", "n_points", "is_new")


def companies_all(spark, sf_dir, companies=None, news=None):
    """K6 + V3: served company records, with trend and is_new against the news-derived prior
    state; names and cities must be non-empty (B8); new first, then by hiring."""
    news = materialise(silver_news(spark, sf_dir), "silver-news") if news is None else news
    g = materialise(gold_company(spark, sf_dir, news=news), "gold-company") if companies is None else companies
    prior, _ = prior_and_snapshot(spark, sf_dir, news)
    as_of = F.to_date(F.lit(SNAPSHOT_DATE))
    snap = H.snapshot_rows(g.withColumnRenamed("company_norm", "company"), as_of,
                           hiring="open_positions", layoffs="total_layoffs")
    hist = H.update_history(prior, snap)
    tr = H.trend(hist)
    recs = (g.where((F.col("company_norm") != "") & (F.col("city") != ""))
            .select(F.col("company_norm").alias("name"), "city", "sector", F.col("company_status").alias("status"),
                    F.col("open_positions").alias("hiring"), F.col("total_layoffs").alias("layoffs"),
                    F.round("avg_sentiment", 3).alias("sentiment"),
                    F.slice("news_titles", 1, 3).alias("news_headlines")))
    recs = recs.join(tr.withColumnRenamed("company", "name"), ["name", "city"], "left")
    recs = H.mark_new(recs.withColumnRenamed("name", "company"), prior).withColumnRenamed("company", "name")
    return recs.orderBy(F.desc("is_new"), F.desc("hiring"), "name", "city")


def _sql_companies_all():
    snap = (f"SELECT company_norm AS company, city, '{SNAPSHOT_DATE}' AS date, CAST(open_positions AS BIGINT) AS hiring, "
            f"CAST(total_layoffs AS BIGINT) AS layoffs, CAST(open_positions - total_layoffs AS BIGINT) AS score FROM _gold")
    both = f"SELECT *, 0 AS _prio FROM _prior UNION ALL SELECT *, 1 AS _prio FROM ({snap})"
    one = (f"SELECT company, city, date, hiring, layoffs, score FROM (SELECT *, row_number() OVER (PARTITION BY company, city, date "
           f"ORDER BY _prio DESC, hiring DESC, layoffs DESC, score DESC) AS _r FROM ({both})) WHERE _r = 1")
    hist = (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY company, city ORDER BY date DESC) AS _rn FROM ({one})) "
            f"WHERE _rn <= {D.HISTORY_POINTS}")
    scaled = (f"SELECT company, city, date, greatest({D.TREND_MIN}, least({D.TREND_MAX}, "
              f"CAST(floor((score - mn) / (CASE WHEN mx - mn = 0 THEN 1 ELSE mx - mn END) * {D.TREND_SPAN}) AS INT) + {D.TREND_MIN})) AS t "
              f"FROM (SELECT *, min(score) OVER (PARTITION BY company, city) AS mn, max(score) OVER (PARTITION BY company, city) AS mx FROM ({hist}))")
    tr = f"SELECT company, city, list(t ORDER BY date) AS trend FROM ({scaled}) GROUP BY 1, 2"
    return f"""
WITH _gold AS MATERIALIZED ({sql_gold_company()}), _prior AS MATERIALIZED ({_sql_daily_and_snap()[0]})
SELECT g.company_norm AS name, g.city, g.sector, g.company_status AS status, g.open_positions AS hiring,
       g.total_layoffs AS layoffs, round(g.avg_sentiment, 3) AS sentiment,
       array_to_string(g.news_titles[1:3], ' || ') AS news_headlines, array_to_string(t.trend, ',') AS trend,
       p.company IS NULL AS is_new
FROM _gold g LEFT JOIN ({tr}) t ON g.company_norm = t.company AND g.city = t.city
LEFT JOIN (SELECT DISTINCT company, city FROM _prior) p ON g.company_norm = p.company AND g.city = p.city
WHERE g.company_norm <> '' AND g.city <> ''"""


@register("companies_all", sql=_sql_companies_all, ops="K6 V3 V2 V1 J9 B8 B11 X12")
def q_companies_all(spark, sf_dir):
    c = companies_all(spark, sf_dir)
    return c.select("name", "city", "sector", "status", "hiring", "layoffs", "sentiment",
                    F.array_join("news_headlines", " || ").alias("news_headlines"),
                    F.array_join(F.col("trend").cast("array<string>"), ",").alias("trend"), "is_new")


# ------------------------------------------------------------------ payroll

def payroll_portal_html(spark, sf_dir):
    """One landed portal page per region: a table whose header row names the
    fields and whose body rows carry the region's monthly additions."""
    o = tables.read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    c = tables.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = tables.read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = tables.read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    agg = (o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
           .join(r, F.col("n_regionkey") == r.r_regionkey)
           .groupBy("r_regionkey", "r_name", F.date_format("o_orderdate", "yyyy-MM").alias("ym"))
           .agg(F.count(F.lit(1)).alias("n")))
    row = F.format_string("<tr><td>%s</td><td>%s</td><td>%s</td></tr>", F.lower("r_name"), F.col("ym"),
                          F.format_number(F.col("n") * 7, 0))
    page = (agg.groupBy("r_regionkey").agg(F.array_sort(F.collect_list(F.struct("ym", row.alias("tr")))).alias("_rows"))
            .select(F.col("r_regionkey").alias("page_id"),
                    F.concat(F.lit("<html><body><table><tr><th>State Name</th><th>Month</th><th>Payroll Addition</th></tr>"),
                             F.array_join(F.transform("_rows", lambda e: e.getField("tr")), ""),
                             F.lit("</table></body></html>")).alias("html")))
    return page


def payroll_records(spark, sf_dir):
    """T4: API records and portal-table records (both raw maps) in one relation."""
    api = tables.payroll_api_raw(spark, sf_dir).select(F.lit("payroll_api").alias("origin"), "rec")
    portal = header_records(payroll_portal_html(spark, sf_dir), "html", ["page_id"])
    return api.unionByName(portal.select(F.lit("payroll_portal").alias("origin"), "rec"))


def payroll_by_city(spark, sf_dir):
    """B2/B3/B8 normalisation then J6 + Y8 split to cities."""
    f = lambda k: F.try_element_at(F.col("rec"), F.lit(k))
    state = title_case(strip_ws(F.coalesce(first_nonempty(*[f(k) for k in tables.PAYROLL_STATE_FIELDS]), F.lit(""))))
    month = F.coalesce(first_nonempty(*[f(k) for k in tables.PAYROLL_MONTH_FIELDS]), F.lit(""))
    value = first_int(*[f(k) for k in tables.PAYROLL_VALUE_FIELDS + ["no_of_employees"]])
    norm = (payroll_records(spark, sf_dir)
            .select("origin", state.alias("state"), month.alias("month"), value.alias("value"))
            .where((F.col("state") != "") & F.col("value").isNotNull()))
    fixed = spark.createDataFrame(list(D.STATE_CITIES), "state string, cities array<string>")
    cities = tables.region_cities(spark, sf_dir).unionByName(fixed)
    split = split_by_city(norm, cities)
    return split.select("origin", "state", "city", F.lit("new_subscribers").alias("metric"),
                        F.col("city_value").alias("value"), "month", F.col("value").alias("raw_state_val"),
                        F.col("_pos").cast("bigint").alias("city_rank"))


def _sql_payroll():
    reg = "(SELECT r.r_regionkey AS k, r.r_name, strftime(o.o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders o " \
          "JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey " \
          "JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY 1, 2, 3)"
    api = f"SELECT 'payroll_api' AS origin, {S.title_case(S.strip_ws('lower(r_name)'))} AS state, ym AS month, n * 1000 AS value FROM {reg}"
    portal = f"SELECT 'payroll_portal' AS origin, {S.title_case(S.strip_ws('lower(r_name)'))} AS state, ym AS month, n * 7 AS value FROM {reg}"
    fixed = " UNION ALL ".join(f"SELECT {S.q(s)} AS state, [{', '.join(S.q(c) for c in cs)}] AS cities" for s, cs in D.STATE_CITIES)
    reg_cities = (f"SELECT {S.title_case('r.r_name')} AS state, list(n.n_name ORDER BY n.n_nationkey) AS cities "
                  f"FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name")
    cities = f"{reg_cities} UNION ALL {fixed}"
    base = f"SELECT p.*, coalesce(c.cities, [p.state]) AS cl FROM ({api} UNION ALL {portal}) p LEFT JOIN ({cities}) c ON p.state = c.state"
    return f"""
SELECT origin, state, cl[i] AS city, 'new_subscribers' AS metric,
       CAST(CASE WHEN i = 1 THEN (value - (value % len(cl))) // len(cl) + (value % len(cl)) ELSE (value - (value % len(cl))) // len(cl) END AS BIGINT) AS value,
       month, CAST(value AS BIGINT) AS raw_state_val, CAST(i - 1 AS BIGINT) AS city_rank
FROM (SELECT *, unnest(range(1, len(cl) + 1)) AS i FROM ({base}))"""


@register("payroll_by_city", sql=_sql_payroll, ops="B2 B3 B8 B10 J6 Y8 Y9 T4 A8 X10")
def q_payroll_by_city(spark, sf_dir):
    return payroll_by_city(spark, sf_dir)
