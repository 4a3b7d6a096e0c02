"""Registered queries: text operators (X3-X14, Y1, B9, B3) on whole tables.

Inputs are the free-text tables (documents, conversations, pages) and text
Spark derives from the generated tables (news headlines, relative-date text,
register names). Every query scans its whole input.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from laborlens.catalog import roles_sql as R
from laborlens.catalog import sqlgen as S
from laborlens.catalog.core import dic, ts
from laborlens.catalog.registry import register
from laborlens.functions import dictionaries as D
from laborlens.functions import text as X
from laborlens.functions.dates import relative_date
from laborlens.sources import tables


def _t(spark, sf_dir, name):
    """A whole input table."""
    return tables.read(spark, sf_dir, name)


@register("document_sector", sql=lambda: f"""
SELECT doc_id, {S.classify_sector('source', 'text', dic().sectors)} AS sector,
       {S.classify_keywords('lower(text)', D.REGISTER_SECTOR_KEYWORDS)} AS register_sector
FROM documents""", ops="X3 X4")
def q_document_sector(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", X.classify_sector("source", "text", dic().sectors).alias("sector"),
                    X.classify_keywords(F.lower("text"), D.REGISTER_SECTOR_KEYWORDS).alias("register_sector"))


@register("sector_of_companies", sql=lambda: f"""
SELECT c_custkey, {S.classify_sector('c_name', 'c_mktsegment', dic().sectors)} AS sector,
       {S.classify_register_sector('c_mktsegment', dic().register_sectors)} AS register_sector
FROM customer""", ops="X3 X4 J8")
def q_sector_of_companies(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", X.classify_sector("c_name", "c_mktsegment", dic().sectors).alias("sector"),
                    X.classify_register_sector("c_mktsegment", dic().register_sectors).alias("register_sector"))


@register("signal_classify", sql=lambda: f"""
SELECT 'news' AS src, e.event_id AS id, {S.classify_signal('t.title', 't.description')} AS signal
FROM ({R.NEWS.replace('SELECT ', 'SELECT e.event_id AS event_id, ', 1)}) t JOIN events e ON t.event_id = e.event_id
UNION ALL
SELECT 'conversation' AS src, conv_id * 1000 + turn AS id, {S.classify_signal('role', 'text')} AS signal FROM conversations
UNION ALL
SELECT 'document' AS src, doc_id AS id, {S.classify_signal('source', 'text')} AS signal FROM documents""",
          ops="X5")
def q_signal_classify(spark, sf_dir):
    news = _news_projection(spark, sf_dir)
    a = news.select(F.lit("news").alias("src"), F.col("event_id").alias("id"),
                    X.classify_signal("title", "description").alias("signal"))
    b = _t(spark, sf_dir, "conversations").select(
        F.lit("conversation").alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        X.classify_signal("role", "text").alias("signal"))
    c = _t(spark, sf_dir, "documents").select(F.lit("document").alias("src"), F.col("doc_id").alias("id"),
                                              X.classify_signal("source", "text").alias("signal"))
    return a.unionByName(b).unionByName(c)


def _news_projection(spark, sf_dir):
    """News records with the event id kept (identifies each headline)."""
    return tables.news_signals(spark, sf_dir, keep_id=True)


@register("headline_extract", sql=lambda: f"""
SELECT e.event_id, {S.extract_headcount('t.title')} AS headcount, {S.extract_company('t.title')} AS company,
       {S.extract_city("t.title || ' ' || coalesce(t.city, '')")} AS city_mention
FROM ({R.NEWS.replace('SELECT ', 'SELECT e.event_id AS event_id, ', 1)}) t JOIN events e ON t.event_id = e.event_id""",
          ops="X6 X7 X8")
def q_headline_extract(spark, sf_dir):
    n = _news_projection(spark, sf_dir)
    return n.select("event_id", X.extract_headcount("title").alias("headcount"),
                    X.extract_company("title").alias("company"),
                    X.extract_city(F.concat(F.col("title"), F.lit(" "), F.coalesce("city", F.lit("")))).alias("city_mention"))


@register("document_extract", sql=lambda: f"""
SELECT doc_id, {S.extract_headcount('text')} AS headcount, {S.extract_company('text')} AS company,
       {S.extract_city('text')} AS city_mention
FROM documents""", ops="X6 X7 X8")
def q_document_extract(spark, sf_dir):
    # a file may hold few row groups and the patterns are CPU work: the texts are dealt out
    d = _t(spark, sf_dir, "documents").select("doc_id", "text").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return d.select("doc_id", X.extract_headcount("text").alias("headcount"),
                    X.extract_company("text").alias("company"), X.extract_city("text").alias("city_mention"))


@register("page_text", sql=lambda: f"""
SELECT page_id, {S.strip_html('html', 500)} AS description, length({S.strip_html('html')}) AS n_chars,
       string_split(url, '/')[3] AS host
FROM pages""", ops="X9 X14")
def q_page_text(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    return p.select("page_id", X.strip_html("html", 500).alias("description"), F.length(X.strip_html("html")).cast("bigint").alias("n_chars"),
                    X.url_host("url").alias("host"))


@register("page_text_whole", sql=lambda: f"""
SELECT page_id, {S.strip_html('html')} AS text FROM pages""", ops="X9")
def q_page_text_whole(spark, sf_dir):
    """The whole stripped text of each page, of which page_text serves the first 500 characters."""
    return _t(spark, sf_dir, "pages").select("page_id", X.strip_html("html").alias("text"))


@register("name_title_case", sql=lambda: f"""
SELECT n_nationkey, {S.title_case('n_name')} AS city_title, {S.normalise_city('n_name', dic().city_aliases)} AS city,
       {S.normalise_city('n_name')} AS city_fixed_map,
       translate(lower(CASE WHEN n_name IS NULL OR n_name = '' THEN 'Unknown' ELSE {S.normalise_city('n_name', dic().city_aliases)} END), ' /', '__') AS city_slug
FROM nation""", ops="X2 X11 J8")
def q_name_title_case(spark, sf_dir):
    n = _t(spark, sf_dir, "nation")
    city = X.normalise_city("n_name", dic().city_aliases)
    return n.select("n_nationkey", X.title_case("n_name").alias("city_title"), city.alias("city"),
                    X.normalise_city("n_name").alias("city_fixed_map"), X.slug(city).alias("city_slug"))


@register("part_title_case", sql=lambda: f"""
SELECT p_partkey, {S.title_case('p_name')} AS title, {S.title_case("p_type || '''s ' || p_brand")} AS label
FROM part""", ops="X11")
def q_part_title_case(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select("p_partkey", X.title_case("p_name").alias("title"),
                    X.title_case(F.concat("p_type", F.lit("'s "), "p_brand")).alias("label"))


RELATIVE_AS_OF = "2001-08-02 06:00:00"


def _relative_text_sql() -> str:
    return f"""
SELECT o_orderkey,
       CASE o_orderpriority
         WHEN '1-URGENT' THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(TIMESTAMP '{RELATIVE_AS_OF}' AS DATE)) AS VARCHAR) || ' days ago'
         WHEN '2-HIGH' THEN CAST(dayofmonth(o_orderdate) AS VARCHAR) || ' Hours ago'
         WHEN '3-MEDIUM' THEN CAST(month(o_orderdate) AS VARCHAR) || ' weeks ago'
         WHEN '4-NOT SPECIFIED' THEN 'Posted ' || CAST(quarter(o_orderdate) AS VARCHAR) || 'month'
         ELSE CASE WHEN o_orderstatus = 'F' THEN '30+ Days Ago' ELSE 'Today' END END AS posted_text
FROM orders"""


@register("relative_posting_date", sql=lambda: f"""
SELECT o_orderkey, posted_text,
       CASE WHEN posted_text IS NULL OR posted_text = '' THEN ''
            WHEN regexp_extract(posted_text, '(?i)(\\d+)\\s*(day|hour|week|month)', 2) = '' THEN posted_text
            ELSE strftime(CASE lower(regexp_extract(posted_text, '(?i)(\\d+)\\s*(day|hour|week|month)', 2))
              WHEN 'hour' THEN CAST(TIMESTAMP '{RELATIVE_AS_OF}' - to_hours(CAST(regexp_extract(posted_text, '(?i)(\\d+)\\s*(day|hour|week|month)', 1) AS INT)) AS DATE)
              WHEN 'day' THEN CAST(TIMESTAMP '{RELATIVE_AS_OF}' AS DATE) - CAST(regexp_extract(posted_text, '(?i)(\\d+)\\s*(day|hour|week|month)', 1) AS INT)
              WHEN 'week' THEN CAST(TIMESTAMP '{RELATIVE_AS_OF}' AS DATE) - 7 * CAST(regexp_extract(posted_text, '(?i)(\\d+)\\s*(day|hour|week|month)', 1) AS INT)
              ELSE CAST(TIMESTAMP '{RELATIVE_AS_OF}' AS DATE) - 30 * CAST(regexp_extract(posted_text, '(?i)(\\d+)\\s*(day|hour|week|month)', 1) AS INT) END,
              '%Y-%m-%d') END AS posted_date
FROM ({_relative_text_sql()})""", ops="Y1")
def q_relative_date(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    as_of = ts(RELATIVE_AS_OF)
    days = F.datediff(F.to_date(as_of), F.to_date("o_orderdate"))
    # the posting-age text a board shows varies with the order's priority class
    text = (F.when(pr == "1-URGENT", F.concat(days.cast("string"), F.lit(" days ago")))
            .when(pr == "2-HIGH", F.concat(F.dayofmonth("o_orderdate").cast("string"), F.lit(" Hours ago")))
            .when(pr == "3-MEDIUM", F.concat(F.month("o_orderdate").cast("string"), F.lit(" weeks ago")))
            .when(pr == "4-NOT SPECIFIED", F.concat(F.lit("Posted "), F.quarter("o_orderdate").cast("string"),
                                                    F.lit("month")))
            .otherwise(F.when(F.col("o_orderstatus") == "F", F.lit("30+ Days Ago")).otherwise(F.lit("Today"))))
    return (o.select("o_orderkey", text.alias("posted_text"))
            .withColumn("posted_date", relative_date("posted_text", as_of)))


@register("tracker_headline", sql=lambda: f"""
SELECT s.s_suppkey, s.s_name || ' lays off ' || format('{{:,}}', CAST(floor(s.s_acctbal) AS BIGINT)) || ' employees' AS title,
       concat_ws(' | ', s.s_name, 'Supplier', n.n_name) AS description,
       TRY_CAST(regexp_replace(format('{{:,}}', CAST(floor(s.s_acctbal) AS BIGINT)), '[^0-9]', '', 'g') AS BIGINT) AS headcount
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""", ops="X13 X10")
def q_tracker_headline(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier")
    n = _t(spark, sf_dir, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    raw = F.format_number(F.floor("s_acctbal"), 0)
    return j.select("s_suppkey", X.layoff_headline("s_name", raw).alias("title"),
                    X.tracker_description("s_name", F.lit("Supplier"), "n_name").alias("description"),
                    X.digits_only(raw).alias("headcount"))
