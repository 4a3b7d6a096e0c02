"""DuckDB twins of the record roles (sources/tables.py) and of the silver/gold plans."""

from __future__ import annotations

from laborlens.catalog import sqlgen as S
from laborlens.plans.silver import Dictionaries

ISO = "'%Y-%m-%dT%H:%M:%SZ'"

JOBS = f"""
SELECT p.p_name AS title, c.c_name AS company, n.n_name AS location, lower(n.n_name) AS city_key,
       CAST(NULL AS VARCHAR) AS experience,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(CAST(round(l.l_extendedprice) AS BIGINT) AS VARCHAR) END AS salary,
       strftime(o.o_orderdate, '%Y-%m-%d') AS posted_date,
       'https://jobs.example/' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS job_url,
       CASE WHEN o.o_orderstatus = 'F' THEN 'board_a' ELSE 'board_b' END AS source,
       strftime(l.l_shipdate, {ISO}) AS scraped_at
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey
"""

_COMPANY = "('Customer#' || lpad(CAST(e.user_id AS VARCHAR), 9, '0'))"
_SIGNAL = "(CASE WHEN e.event_type = 'error' THEN 'layoff' WHEN e.event_type IN ('signup', 'purchase') THEN 'hiring' ELSE 'neutral' END)"
_HC = f"(CASE WHEN {_SIGNAL} <> 'neutral' THEN CAST(floor(e.value * 20) AS BIGINT) END)"

NEWS = f"""
SELECT {_COMPANY} || ' ' || CASE
         WHEN e.event_type = 'error' THEN 'layoff: ' || CAST({_HC} AS VARCHAR) || ' employees laid off'
         WHEN e.event_type = 'signup' THEN 'is hiring ' || CAST({_HC} AS VARCHAR) || ' freshers'
         WHEN e.event_type = 'purchase' THEN 'announces mass hiring'
         WHEN e.event_type = 'click' THEN 'posts quarterly results'
         ELSE 'opens a new office' END AS title,
       e.props AS description,
       {_COMPANY} AS company,
       n.n_name AS city,
       {_HC} AS headcount,
       {_SIGNAL} AS signal_type,
       CASE WHEN e.event_type = 'click' THEN strftime(e.ts, '%a, %d %b %Y %H:%M:%S GMT')
            ELSE strftime(e.ts, {ISO}) END AS published_at,
       'https://news.example/' || CAST(e.user_id AS VARCHAR) || '/' || e.event_type || '/' || strftime(e.ts, '%Y-%m-%d') AS url,
       'feed_' || e.event_type AS source_name,
       CASE WHEN e.event_type = 'click' THEN 'rss' ELSE 'api' END AS source,
       strftime(e.ts, {ISO}) AS scraped_at
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

REGISTER_API_RAW = """
SELECT CASE WHEN n.n_regionkey < 3 THEN s.s_name END AS company_name,
       CASE WHEN n.n_regionkey >= 3 THEN s.s_name END AS company_name_uc,
       CAST(NULL AS VARCHAR) AS name,
       CASE WHEN n.n_regionkey < 3 THEN 'active' END AS company_status,
       CASE WHEN n.n_regionkey >= 3 THEN 'ACTIVE' END AS status_uc,
       CASE WHEN n.n_regionkey < 3 THEN 'RoC-' || n.n_name END AS roc_code,
       CASE WHEN n.n_regionkey >= 3 THEN 'RoC-' || n.n_name END AS roc_code_uc,
       lower(r.r_name) AS state_name,
       CASE WHEN n.n_regionkey < 3 THEN 'U' || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0') END AS cin,
       CASE WHEN n.n_regionkey >= 3 THEN 'L' || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0') END AS cin_uc,
       CAST(NULL AS VARCHAR) AS company_class, CAST(NULL AS VARCHAR) AS class_uc,
       CAST(NULL AS VARCHAR) AS company_category, CAST(NULL AS VARCHAR) AS category_uc,
       CAST(NULL AS VARCHAR) AS date_of_incorporation, CAST(NULL AS VARCHAR) AS date_of_incorp_uc,
       CAST(NULL AS VARCHAR) AS authorized_capital, CAST(NULL AS VARCHAR) AS authorized_cap_uc,
       CAST(NULL AS VARCHAR) AS paidup_capital, CAST(NULL AS VARCHAR) AS paidup_cap_uc
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def register_seed() -> str:
    return f"""
SELECT c.c_name AS name, 'C' || CAST(c.c_nationkey AS VARCHAR) AS cin_prefix,
       {S.title_case('r.r_name')} AS state, n.n_name AS city, {S.title_case('c.c_mktsegment')} AS sector,
       'Active' AS status, '' AS incorporation_year, '' AS authorized_capital, '' AS paid_up_capital,
       'curated_seed' AS source, '2024-01-01T00:00:01Z' AS scraped_at
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def register_from_api(dic: Dictionaries) -> str:
    name = S.title_case(S.strip_ws(S.first_nonempty("company_name", 'company_name_uc', "name")))
    status = S.title_case(S.strip_ws(f"coalesce({S.first_nonempty('company_status', 'status_uc')}, 'Unknown')"))
    roc = S.strip_ws(f"coalesce({S.first_nonempty('roc_code', 'roc_code_uc')}, '')")
    state = S.exact_lookup(roc, dic.roc_states, S.title_case(S.strip_ws("coalesce(state_name, '')")))
    fn = S.first_nonempty
    inner = f"""
SELECT {name} AS name, coalesce({fn('cin', 'cin_uc')}, '') AS cin, CAST(NULL AS VARCHAR) AS cin_prefix,
       {status} AS status, coalesce({fn('company_class', 'class_uc')}, '') AS class,
       coalesce({fn('company_category', 'category_uc')}, '') AS category, {state} AS state, '' AS city,
       {roc} AS roc, coalesce({fn('date_of_incorporation', 'date_of_incorp_uc')}, '') AS incorporation_date,
       CAST(NULL AS VARCHAR) AS incorporation_year,
       coalesce({fn('authorized_capital', 'authorized_cap_uc')}, '') AS authorized_capital,
       coalesce({fn('paidup_capital', 'paidup_cap_uc')}, '') AS paid_up_capital,
       'api' AS source, '2024-01-01T00:00:00Z' AS scraped_at
FROM ({REGISTER_API_RAW})"""
    return f"SELECT *, {S.classify_register_sector('name', dic.register_sectors)} AS sector FROM ({inner}) WHERE name <> ''"


REGISTER_COLUMNS = ["name", "cin", "cin_prefix", "status", "class", "category", "state", "city", "roc",
                    "incorporation_date", "incorporation_year", "authorized_capital", "paid_up_capital",
                    "sector", "source", "scraped_at"]


def register_bronze(dic: Dictionaries) -> str:
    """API rows union seed rows by name (missing columns as nulls)."""
    return (f"SELECT {', '.join(REGISTER_COLUMNS)} FROM ({register_from_api(dic)}) "
            f"UNION ALL BY NAME SELECT * FROM ({register_seed()})")


def company_map(src: str, col: str, out: str, dic: Dictionaries, min_len: int = 2) -> str:
    """map_distinct twin: X1 once per distinct value, joined back null-safely."""
    m = S.company_names(src, col, out, dic.canonical, dic.cutoff, min_len)
    return f"SELECT s.*, m.{out} FROM ({src}) s LEFT JOIN ({m}) m ON s.{col} IS NOT DISTINCT FROM m._k"


JOB_COLUMNS = ["title", "company", "location", "city_key", "experience", "salary", "posted_date",
               "job_url", "source", "scraped_at"]
NEWS_COLUMNS = ["title", "description", "company", "city", "headcount", "signal_type", "published_at",
                "url", "source_name", "source", "scraped_at"]


def silver_jobs(dic: Dictionaries) -> str:
    with_norm = company_map(JOBS, "company", "company_norm", dic)
    cols = [c for c in JOB_COLUMNS if c not in ("posted_date",)]
    step = f"""
SELECT {', '.join(c for c in cols)}, TRY_CAST(try_strptime(posted_date, '%Y-%m-%d') AS DATE) AS posted_date,
       company_norm, {S.normalise_city("coalesce(nullif(city_key, ''), location)", dic.city_aliases)} AS city
FROM ({with_norm}) WHERE length(company_norm) > 2"""
    all_cols = cols + ["posted_date", "company_norm", "city"]
    return S.keep_first(step, ["company_norm", "title", "city"], ["scraped_at", "job_url"], _spark_job_order(all_cols))


def _spark_job_order(cols):
    # column order of the Spark silver jobs frame (bronze columns, company_norm, then city)
    order = JOB_COLUMNS + ["company_norm", "city"]
    return [c for c in order if c in cols]


def silver_news(dic: Dictionaries, as_of: str, window_days: int = 30) -> str:
    with_norm = company_map(NEWS, "company", "company_norm", dic)
    step = f"""
SELECT title, description, company, city, headcount, signal_type, published_at, url, source_name, source,
       scraped_at, company_norm, published_ts, score_tenths, score_tenths / 10.0 AS signal_score,
       {S.news_url_key('url', 'title', 'company')} AS url_key
FROM (SELECT title, description, company, {S.normalise_city('city', dic.city_aliases)} AS city, headcount,
             signal_type, published_at, url, source_name, source, scraped_at, company_norm,
             {S.parse_published('published_at')} AS published_ts,
             {S.signal_score_tenths('signal_type', 'headcount')} AS score_tenths
      FROM ({with_norm}))
WHERE signal_type IN ('layoff', 'hiring', 'neutral') AND published_ts IS NOT NULL
  AND CAST(published_ts AS DATE) >= CAST(TIMESTAMP '{as_of}' AS DATE) - INTERVAL {window_days} DAY"""
    out_cols = NEWS_COLUMNS + ["company_norm", "published_ts", "score_tenths", "signal_score", "url_key"]
    return S.keep_first(step, ["url_key"], ["scraped_at", "published_ts", "title"], out_cols)


def silver_register(dic: Dictionaries) -> str:
    with_norm = company_map(register_bronze(dic), "name", "name_norm", dic)
    cols = [c for c in REGISTER_COLUMNS if c != "city"]
    step = f"SELECT {', '.join(cols)}, {S.normalise_city('city', dic.city_aliases)} AS city, name_norm FROM ({with_norm})"
    out_cols = REGISTER_COLUMNS + ["name_norm"]
    return S.keep_first(step, ["name_norm"], ["scraped_at", "name"], out_cols)
