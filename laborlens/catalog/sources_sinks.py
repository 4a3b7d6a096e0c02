"""Registered queries: landing and reading round trips.

Each query writes Spark-derived data to a fresh directory under the shared
checkpoint folder, reads it back through the source operator under test and
returns the read-back relation, so the result is checked against the SQL
twin computed straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlens import schemas
from laborlens.catalog import roles_sql as R
from laborlens.catalog import sqlgen as S
from laborlens.catalog.core import (NEWS_AS_OF, bronze_register, city_rollup, dic, gold_company, silver_news,
                                    sql_city_rollup, sql_gold_company, ts)
from laborlens.catalog.registry import register
from laborlens.functions import text as X
from laborlens.functions.dates import parse_published
from laborlens.operators.html import card_postings, ld_postings, page_postings, table_rows
from laborlens.session import materialise, scratch_path
from laborlens.sinks import documents as K
from laborlens.sinks.landing import land_chunked, land_envelopes
from laborlens.sinks.snapshots import SnapshotTable
from laborlens.sources import bronze, tables

RUN_TS = "20240131T060000Z"
BATCH_TS = "2024-01-31T06:00:00Z"
JOB_FIELDS_B = ["title", "company", "location", "city_key", "posted_date", "job_url", "source", "scraped_at"]


def _land_jobs(spark, sf_dir, root, boards=("board_a", "board_b")):
    jobs = tables.job_postings(spark, sf_dir).where(F.col("source").isin(*boards))
    # the second board sends no experience/salary fields: what is null is not written
    recs = jobs.withColumns({c: F.when(F.col("source") != "board_b", F.col(c))
                             for c in jobs.columns if c not in JOB_FIELDS_B})
    land_envelopes(recs, root, {"source": F.col("source"), "city": F.col("city_key")}, "job_url",
                   "jobs", "job_count", RUN_TS, BATCH_TS)


@register("bronze_jobs_roundtrip", sql=f"""
SELECT title, company, location, city_key, experience, salary, posted_date, job_url, source, scraped_at,
       source AS landed_source, city_key AS landed_city, '{RUN_TS}' AS run_id
FROM ({R.JOBS})""", ops="K1 A1 A2 B1 T1")
def q_bronze_jobs(spark, sf_dir):
    root = scratch_path(spark, "bronze-jobs")
    _land_jobs(spark, sf_dir, root)
    a = bronze.load_source(spark, root, "board_a", schemas.JOB)
    b = bronze.load_source(spark, root, "board_b", schemas.JOB)
    both = a.unionByName(b, allowMissingColumns=True)
    return both.select(*[f.name for f in schemas.JOB.fields], F.col("landed_source"),
                       F.col("landed_city"), "run_id")


@register("bronze_missing_source", sql=f"""
SELECT title, company, job_url, source FROM ({R.JOBS}) WHERE source = 'board_a'""", ops="A3 A1")
def q_missing_source(spark, sf_dir):
    root = scratch_path(spark, "bronze-partial")
    _land_jobs(spark, sf_dir, root, boards=("board_a",))
    a = bronze.load_source(spark, root, "board_a", schemas.JOB)
    missing = bronze.load_source(spark, root, "board_b", schemas.JOB)
    return a.unionByName(missing).select("title", "company", "job_url", "source")


@register("bronze_source_counts", sql=f"""
SELECT source AS landed_source, count(*) AS records FROM ({R.JOBS}) GROUP BY 1
UNION ALL SELECT 'news', count(*) FROM events
UNION ALL SELECT 'register', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM customer)""", ops="A4 K1 K2")
def q_source_counts(spark, sf_dir):
    root = scratch_path(spark, "bronze-all")
    _land_jobs(spark, sf_dir, root)
    news = tables.news_signals(spark, sf_dir)
    land_envelopes(news, root, {"source": F.lit("news")}, "url", "records", "record_count", RUN_TS, BATCH_TS)
    reg = bronze_register(spark, sf_dir)
    land_envelopes(reg, root, {"source": F.lit("register")}, "name", "records", "record_count", RUN_TS, BATCH_TS)
    parts = [bronze.load_source(spark, root, s, rec).select("landed_source")
             for s, rec in (("board_a", schemas.JOB), ("board_b", schemas.JOB), ("news", schemas.NEWS),
                            ("register", schemas.REGISTER))]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return bronze.source_counts(u)


@register("register_chunks", sql="""
SELECT name, CAST(floor((rn - 1) / 500) AS INT) AS chunk,
       CAST(least(500, total - floor((rn - 1) / 500) * 500) AS BIGINT) AS record_count
FROM (SELECT name, row_number() OVER (ORDER BY ordinal) AS rn, count(*) OVER () AS total FROM (
  SELECT s_name AS name, CAST(s_suppkey AS BIGINT) AS ordinal FROM supplier
  UNION ALL SELECT c_name, 1000000000000 + c_custkey FROM customer))""", ops="K2")
def q_register_chunks(spark, sf_dir):
    s = tables.read(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("ordinal"))
    c = tables.read(spark, sf_dir, "customer").select(F.col("c_name").alias("name"),
                                                      (F.lit(1000000000000) + F.col("c_custkey")).alias("ordinal"))
    root = scratch_path(spark, "register-chunks")
    land_chunked(s.unionByName(c), root, "register", "ordinal", RUN_TS, BATCH_TS)
    back = spark.read.schema("chunk_index int, record_count long, records array<struct<name:string,ordinal:long>>").option(
        "recursiveFileLookup", "true").json(root)
    return back.select(F.explode("records.name").alias("name"), F.col("chunk_index").alias("chunk"), "record_count")


RSS_SCHEMA = T.StructType([T.StructField("title", T.StringType()), T.StructField("link", T.StringType()),
                           T.StructField("pubDate", T.StringType()), T.StructField("description", T.StringType())])


@register("rss_items_roundtrip", sql=f"""
SELECT url AS link, title, strftime({S.parse_published('published_at')}, '%Y-%m-%d %H:%M:%S') AS published,
       {S.strip_html("'<p>' || description || '</p>'", 500)} AS description,
       {S.classify_signal('title', S.strip_html("'<p>' || description || '</p>'"))} AS signal_type,
       {S.extract_headcount("title || ' ' || " + S.strip_html("'<p>' || description || '</p>'"))} AS headcount,
       {S.extract_city("title || ' ' || " + S.strip_html("'<p>' || description || '</p>'"))} AS city
FROM ({R.NEWS}) WHERE source = 'rss'""", ops="A5 X9 X5 X6 X8 Y2 T2")
def q_rss_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "rss")
    news = tables.news_signals(spark, sf_dir).where(F.col("source") == "rss")
    items = news.select("title", F.col("url").alias("link"), F.col("published_at").alias("pubDate"),
                        F.concat(F.lit("<p>"), F.col("description"), F.lit("</p>")).alias("description"))
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").mode("overwrite").save(path)
    back = spark.read.format("xml").option("rowTag", "item").schema(RSS_SCHEMA).load(path)
    desc = X.strip_html("description")
    full = F.concat(F.col("title"), F.lit(" "), desc)
    return back.select("link", "title", F.date_format(parse_published("pubDate"), "yyyy-MM-dd HH:mm:ss").alias("published"),
                       X.strip_html("description", 500).alias("description"), X.classify_signal("title", desc).alias("signal_type"),
                       X.extract_headcount(full).alias("headcount"), X.extract_city(full).alias("city"))


@register("page_job_cards", sql=f"""
SELECT page_id, i - 1 AS card_idx, hrefs[i] AS job_url, texts[i] AS title, company,
       CASE WHEN loc IS NULL OR loc = '' THEN {S.title_case('lang')} ELSE loc END AS location
FROM (SELECT page_id, hrefs, texts, company, '' AS loc, lang, unnest(range(1, len(hrefs) + 1)) AS i FROM (
  SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
         regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS texts,
         regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS company,
         regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang FROM pages))""", ops="A7")
def q_page_cards(spark, sf_dir):
    p = tables.read(spark, sf_dir, "pages")
    company = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    lang = F.regexp_extract("html", r'<html lang="([a-z]+)"', 1)
    cards = p.select("page_id", F.posexplode(card_postings(F.col("html"), company, city=lang, as_of=F.to_timestamp(F.lit(BATCH_TS))))
                     .alias("card_idx", "card"))
    return cards.select("page_id", F.col("card_idx").cast("bigint").alias("card_idx"), "card.job_url", "card.title",
                        "card.company", "card.location")


@register("jsonld_postings", sql=f"""
SELECT title, company, posted_date, job_url, salary FROM ({R.JOBS})""", ops="A6 Y11")
def q_jsonld(spark, sf_dir):
    jobs = tables.job_postings(spark, sf_dir)
    # per-order pages: one JSON-LD block per posting (a single list block on the first board's pages)
    # plus one non-posting block
    j = jobs.withColumn("_ok", F.regexp_extract("job_url", r"/(\d+)-", 1).cast("bigint")) \
            .withColumn("_ln", F.regexp_extract("job_url", r"-(\d+)$", 1).cast("int"))
    obj = F.to_json(F.struct(F.lit("JobPosting").alias("@type"), F.col("title"),
                             F.struct(F.col("company").alias("name")).alias("hiringOrganization"),
                             F.col("posted_date").alias("datePosted"), F.col("job_url").alias("url"),
                             F.struct(F.struct(F.col("salary").alias("value")).alias("value")).alias("baseSalary")))
    pages = (j.groupBy("_ok", "source").agg(F.array_sort(F.collect_list(F.struct("_ln", "job_url", obj.alias("o")))).alias("_objs"))
             .select("_ok", "source", F.transform("_objs", lambda e: e.getField("o")).alias("objs")))
    block = lambda body: F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    html = F.when(F.col("source") == "board_a", block(F.concat(F.lit("["), F.array_join("objs", ","), F.lit("]")))) \
        .otherwise(F.array_join(F.transform("objs", block), ""))
    html = F.concat(F.lit("<html><body>"), html, block(F.lit('{"@type":"Organization","name":"x"}')), F.lit("</body></html>"))
    page = pages.select("_ok", html.alias("html"))
    post = page.select(F.explode(ld_postings(F.col("html"))).alias("p"))
    return post.select("p.title", "p.company", "p.posted_date", "p.job_url", "p.salary")


def _board_pages(spark, sf_dir):
    """One list page per order: its postings as cards of the order's board, and a JSON-LD
    block as pages write it (attributes, quotes, white space, upper-case tags)."""
    def esc(c):
        return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    j = tables.job_postings(spark, sf_dir).select(
        "source", "company", "location", "job_url", "posted_date", "salary", F.concat("title", F.lit(" R&D")).alias("title"),
        F.regexp_extract("job_url", r"/(\d+)-", 1).cast("bigint").alias("_ok"), F.regexp_extract("job_url", r"-(\d+)$", 1).cast("int").alias("_ln"))
    card_a = F.concat(F.lit('<ARTICLE data-id="1" class="jobTuple bgWhite"><a href="'), "job_url", F.lit('" class="title fw500"> '),
                      esc(F.col("title")), F.lit('</a><a class="subTitle">'), esc(F.col("company")),
                      F.lit('</a><ul><li class="location"><span>'), F.col("location"), F.lit('</span><li class="salary"><span>'),
                      F.coalesce("salary", F.lit("")), F.lit('</span></ul><span class="date">'), F.col("_ln").cast("string"),
                      F.lit(" days ago</span></ARTICLE>"))
    card_b = F.concat(F.lit("<div class='base-card'><a class=\"base-card__full-link\" href='"), "job_url",
                      F.lit("'></a><h3 class='base-search-card__title'>\n "), esc(F.col("title")),
                      F.lit(" </h3><h4 class='base-search-card__subtitle'>"), esc(F.col("company")),
                      F.lit("</h4><time datetime='"), "posted_date", F.lit("'>some days ago</time></div>"))
    ld = F.to_json(F.struct(F.lit("JobPosting").alias("@type"), F.col("title"), F.struct(F.col("company").alias("name")).alias("hiringOrganization"),
                            F.col("posted_date").alias("datePosted"), F.concat("job_url", F.lit("#ld")).alias("url")))
    item = F.struct("_ln", "job_url", F.when(F.col("source") == "board_a", card_a).otherwise(card_b).alias("card"), ld.alias("ld"))
    pages = j.groupBy("_ok", "source").agg(F.array_sort(F.collect_list(item)).alias("items"))
    cards = F.array_join(F.transform("items", lambda e: e.getField("card")), "\n")
    body = F.concat(F.lit("\n  ["), F.array_join(F.transform("items", lambda e: e.getField("ld")), ", "), F.lit("]\n"))
    script = F.when(F.col("_ok") % 2 == 0, F.concat(F.lit('<script data-rh="true" type="application/ld+json">'), body, F.lit("</script>"))) \
        .otherwise(F.concat(F.lit("<SCRIPT type='application/ld+json' async>"), body, F.lit("</SCRIPT >")))
    return pages.select("_ok", "source", F.concat(F.lit("<html><body>"), cards, script, F.lit("</body></html>")).alias("html"))


@register("board_card_postings", sql=f"""
WITH j AS (SELECT *, CAST(regexp_extract(job_url, '-([0-9]+)$', 1) AS INT) AS ln FROM ({R.JOBS}))
SELECT job_url, title || ' R&D' AS title, company,
       CASE WHEN source = 'board_a' THEN location ELSE 'Some Town' END AS location,
       CASE WHEN source = 'board_a' THEN coalesce(salary, '') ELSE '' END AS salary,
       CASE WHEN source = 'board_a' THEN strftime(DATE '2024-01-31' - ln, '%Y-%m-%d') ELSE posted_date END AS posted_date FROM j
UNION ALL
SELECT job_url || '#ld', title || ' R&D', company, 'Some Town', NULL, posted_date FROM j""", ops="A6 A7 Y1")
def q_board_cards(spark, sf_dir):
    """A7 + A6: list pages with cards of both boards and a JSON-LD block each, all read."""
    pages = _board_pages(spark, sf_dir)
    found = page_postings(F.col("html"), F.lit(""), "both", city=F.lit("some town"), as_of=F.to_timestamp(F.lit(BATCH_TS)))
    return pages.select(F.explode(found).alias("p")).select("p.job_url", "p.title", "p.company", "p.location", "p.salary", "p.posted_date")


def _tracker_pages(spark, sf_dir):
    s = tables.read(spark, sf_dir, "supplier")
    n = tables.read(spark, sf_dir, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    loc = (F.when(F.col("n_regionkey") == 2, F.concat(F.initcap("n_name"), F.lit(", India")))
           .when(F.col("n_regionkey") == 1, F.lit("Pune, MH")).otherwise(F.col("n_name")))
    # every row its own date, some of them before the 30-day window of the news
    day = F.date_format(F.date_add(F.lit("2023-12-22").cast("date"), (F.col("s_suppkey") % 40).cast("int")), "yyyy-MM-dd")
    cells = [F.col("s_name"), F.format_number(F.floor(F.abs("s_acctbal")), 0), day, F.lit("Retail"), loc]
    five = F.concat(*[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells])
    four = F.concat(*[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells[:4]])
    # suppliers with a negative balance come through with a missing cell (4 cells)
    tr = F.concat(F.lit("<tr>"), F.when(F.col("s_acctbal") < 0, four).otherwise(five), F.lit("</tr>"))
    page_key = F.concat_ws("-", F.col("s_nationkey").cast("string"), F.floor(F.col("s_suppkey") / 100).cast("string"))
    return (j.groupBy(page_key.alias("page_id"))
            .agg(F.array_sort(F.collect_list(F.struct("s_suppkey", tr.alias("tr")))).alias("_r"))
            .select("page_id", F.concat(F.lit("<table><tbody>"), F.array_join(F.transform("_r", lambda e: e.getField("tr")), ""),
                                        F.lit("</tbody></table>")).alias("html")))


def _sql_tracker() -> str:
    return _TRACKER_SQL


_TRACKER_SQL = f"""
SELECT company, headcount, title, description, {S.extract_city('location')} AS city
FROM (SELECT s.s_name AS company,
             TRY_CAST(regexp_replace(format('{{:,}}', CAST(floor(abs(s.s_acctbal)) AS BIGINT)), '[^0-9]', '', 'g') AS BIGINT) AS headcount,
             s.s_name || ' lays off ' || format('{{:,}}', CAST(floor(abs(s.s_acctbal)) AS BIGINT)) || ' employees' AS title,
             concat_ws(' | ', s.s_name, 'Retail', loc) AS description, loc AS location
      FROM (SELECT s.*, CASE WHEN n_regionkey = 2 THEN upper(n_name[1]) || lower(n_name[2:]) || ', India'
                             WHEN n_regionkey = 1 THEN 'Pune, MH' ELSE n_name END AS loc
            FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey) s
      WHERE s_acctbal >= 0)
WHERE contains(lower(location), 'india') OR {' OR '.join(f"contains(lower(location), {S.q(c)})" for c in X.D.MENTION_CITIES)}"""


@register("tracker_layoffs", sql=_sql_tracker, ops="A9 B9 X13 X8 X10")
def q_tracker(spark, sf_dir):
    return tracker_rows(spark, sf_dir).drop("date")


def tracker_rows(spark, sf_dir):
    """Typed tracker rows (A9) with the row's own date cell."""
    rows = table_rows(_tracker_pages(spark, sf_dir), "html", ["page_id"]).where(F.size("cells") >= 5)
    c = lambda i: F.get(F.col("cells"), i)
    typed = rows.select(c(0).alias("company"), c(1).alias("hc_raw"), c(2).alias("date"), c(3).alias("industry"),
                        c(4).alias("location"))
    low = F.lower("location")
    india = low.contains("india")
    for city in X.D.MENTION_CITIES:
        india = india | low.contains(city)
    t = typed.where(india)
    return t.select("company", X.digits_only("hc_raw").alias("headcount"),
                    X.layoff_headline("company", "hc_raw").alias("title"),
                    X.tracker_description("company", "industry", "location").alias("description"),
                    X.extract_city("location").alias("city"), "date")


@register("gold_sector_roundtrip", sql=f"""
SELECT sector, CAST(sum(open_positions) AS BIGINT) AS total_hiring, CAST(sum(total_layoffs) AS BIGINT) AS total_layoffs,
       count(company_norm) AS total_companies
FROM ({sql_gold_company(with_titles=False)}) GROUP BY sector""", ops="K3 K10")
def q_gold_roundtrip(spark, sf_dir):
    from laborlens.plans import gold
    table = SnapshotTable(spark, scratch_path(spark, "gold-sector"))
    sectors = materialise(gold.sector(gold_company(spark, sf_dir, with_titles=False)), "gold-sectors")  # two versions read it
    # an older version with fewer columns, then the whole table: read as of the newest commit
    table.overwrite(sectors.select("sector").limit(3), "run-1")
    table.overwrite(sectors, "run-2")
    return table.read()


@register("city_summary_document", sql=lambda: f"""
SELECT city, lat, lng, total_hiring, total_layoffs, total_companies, it_companies, hiring_companies,
       layoff_companies, round(avg_sentiment, 3) AS avg_sentiment, growth_score,
       (SELECT count(*) FROM ({sql_city_rollup()})) AS district_count
FROM ({sql_city_rollup()})""", ops="K4 K9 A10 J4")
def q_city_doc(spark, sf_dir):
    path = scratch_path(spark, "city-summary")
    K.write_city_summary(city_rollup(spark, sf_dir), path, RUN_TS, "2024-01-31")
    return K.read_city_summary(spark, path)


@register("city_company_pages", sql=lambda: f"""
SELECT city_slug, company_norm, sector, company_status, CAST(open_positions AS BIGINT) AS open_positions,
       CAST(total_layoffs AS BIGINT) AS total_layoffs
FROM (SELECT sector, company_status, open_positions, total_layoffs, {S.q('')} || translate(lower(CASE WHEN city IS NULL OR city = '' THEN 'Unknown' ELSE city END), ' /', '__') AS city_slug,
             company_norm FROM ({sql_gold_company(with_titles=False)}))""", ops="K5 G8 X11 A10")
def q_city_pages(spark, sf_dir):
    """K5: per-city documents written in small pages and read back; the union of a
    city's pages is its company list."""
    path = scratch_path(spark, "city-pages")
    g = materialise(gold_company(spark, sf_dir, with_titles=False), "gold-company")  # read for the sizes and for the pages
    K.write_city_pages(K.city_company_pages(g, page_size=50), path)
    return K.read_city_pages(spark, path).select("city_slug", "company_norm", "sector", "company_status",
                                                 "open_positions", "total_layoffs")


@register("companies_document", sql=lambda: f"""
WITH c AS MATERIALIZED ({_sql_companies()})
SELECT name, city, sector, status, hiring, layoffs, is_new, (SELECT count(*) FROM c) AS total,
       (SELECT count(*) FROM c WHERE is_new) AS new_this_run FROM c""", ops="K6 A10 J9")
def q_companies_document(spark, sf_dir):
    """K6: the company list with its header (total, new_this_run), written and read back."""
    from laborlens.catalog.history_ops import companies_all
    path = scratch_path(spark, "companies-all")
    K.write_lines_document(companies_all(spark, sf_dir), path, RUN_TS, "2024-01-31", new_flag="is_new")
    return K.read_lines_document(spark, path, "name string, city string, sector string, status string, hiring long, "
                                              "layoffs long, is_new boolean")


@register("sector_document", sql=lambda: f"""
WITH s AS MATERIALIZED (SELECT sector, CAST(sum(open_positions) AS BIGINT) AS total_hiring,
  CAST(sum(total_layoffs) AS BIGINT) AS total_layoffs, count(company_norm) AS total_companies
  FROM ({sql_gold_company(with_titles=False)}) GROUP BY sector)
SELECT sector, total_hiring, total_layoffs, total_companies, (SELECT count(*) FROM s) AS total FROM s""", ops="K7 A10 G7")
def q_sector_document(spark, sf_dir):
    """K7: the sector document with its header, written and read back."""
    from laborlens.plans import gold
    path = scratch_path(spark, "sectors")
    K.write_lines_document(gold.sector(gold_company(spark, sf_dir, with_titles=False)), path, RUN_TS, "2024-01-31")
    return K.read_lines_document(spark, path, "sector string, total_hiring long, total_layoffs long, "
                                              "total_companies long").drop("new_this_run")


def _sql_companies() -> str:
    from laborlens.catalog.history_ops import _sql_companies_all
    return _sql_companies_all()


def _sql_run_meta():
    from laborlens.catalog.history_ops import _sql_companies_all
    return f"""
WITH c AS MATERIALIZED ({_sql_companies_all()}), r AS MATERIALIZED ({sql_city_rollup()})
SELECT '2024-01-31' AS updated_at, '{RUN_TS}' AS run_ts,
       (SELECT count(*) FROM c) AS total_companies,
       (SELECT count(DISTINCT name) FROM c) AS unique_companies,
       (SELECT count(*) FROM c WHERE is_new) AS new_companies,
       (SELECT count(*) FROM r) AS total_districts,
       '{K.PIPELINE_VERSION}' AS pipeline_version, '{K.ENGINE}' AS engine"""


@register("run_meta", sql=_sql_run_meta, ops="K8 G9 J9")
def q_run_meta(spark, sf_dir):
    from laborlens.catalog.history_ops import companies_all
    news = materialise(silver_news(spark, sf_dir), "silver-news")
    g = materialise(gold_company(spark, sf_dir, news=news), "gold-company")
    return K.run_meta(companies_all(spark, sf_dir, g, news), city_rollup(spark, sf_dir, g), RUN_TS, "2024-01-31",
                      new_flag="is_new", name_col="name")


@register("landed_file_listing", sql=f"""
SELECT 'source=' || source AS source_dir, 'city=' || city_key AS city_dir, count(*) AS records, true AS has_bytes
FROM ({R.JOBS}) GROUP BY 1, 2""", ops="A11")
def q_file_listing(spark, sf_dir):
    root = scratch_path(spark, "listing")
    _land_jobs(spark, sf_dir, root)
    parts = [F.regexp_extract("path", f"({k}=[^/]+)", 1).alias(f"{k}_dir") for k in ("source", "city")]
    files = bronze.list_files(spark, root).select("*", *parts).groupBy("source_dir", "city_dir").agg(
        (F.sum("length") > 0).alias("has_bytes"))
    read = [bronze.read_envelopes(spark, f"{root}/source={b}", schemas.JOB, multiline=False) for b in ("board_a", "board_b")]
    counts = (read[0].unionByName(read[1]).groupBy(F.concat(F.lit("source="), "_source").alias("source_dir"),
                                                   F.concat(F.lit("city="), "_city").alias("city_dir"))
              .agg(F.sum(F.size("jobs")).cast("bigint").alias("records")))
    return files.join(counts, ["source_dir", "city_dir"], "full")


def _ld_pages(spark, sf_dir):
    """Per-order pages carrying only JSON-LD postings (no cards), as in q_jsonld."""
    jobs = tables.job_postings(spark, sf_dir)
    j = jobs.withColumn("_ok", F.regexp_extract("job_url", r"/(\d+)-", 1).cast("bigint")) \
            .withColumn("_ln", F.regexp_extract("job_url", r"-(\d+)$", 1).cast("int"))
    obj = F.to_json(F.struct(F.lit("JobPosting").alias("@type"), F.col("title"),
                             F.struct(F.col("company").alias("name")).alias("hiringOrganization"),
                             F.col("posted_date").alias("datePosted"), F.col("job_url").alias("url"),
                             F.struct(F.struct(F.col("salary").alias("value")).alias("value")).alias("baseSalary")))
    pages = (j.groupBy("_ok").agg(F.array_sort(F.collect_list(F.struct("_ln", "job_url", obj.alias("o")))).alias("_objs"))
             .select(F.concat(F.lit("ld-"), F.col("_ok").cast("string")).alias("page_key"),
                     F.concat(F.lit("<html><body>"),
                              F.array_join(F.transform("_objs", lambda e: F.concat(
                                  F.lit('<script type="application/ld+json">'), e.getField("o"), F.lit("</script>"))), ""),
                              F.lit("</body></html>")).alias("html")))
    return pages


@register("page_postings_fallback", sql=f"""
SELECT page_key, title, company, job_url FROM (
  SELECT 'page-' || CAST(page_id AS VARCHAR) AS page_key, unnest(texts) AS title, company, unnest(hrefs) AS job_url
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
               regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS texts,
               regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) AS company FROM pages))
UNION ALL
SELECT 'ld-' || split_part(split_part(job_url, '/', 4), '-', 1) AS page_key, title, company, job_url FROM ({R.JOBS})""",
          ops="A6 A7")
def q_page_postings(spark, sf_dir):
    """Real pages (cards, no JSON-LD) and JSON-LD-only pages through one
    extractor in fallback mode: cards where a page has them, else its postings."""
    real = tables.read(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("page_key"), "html")
    pages = real.unionByName(_ld_pages(spark, sf_dir))
    company = F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)
    out = pages.select("page_key", F.explode(page_postings(F.col("html"), company, "fallback")).alias("p"))
    return out.select("page_key", "p.title", "p.company", "p.job_url")


def _sql_jobs_url_dedupe() -> str:
    keyed = (f"SELECT *, coalesce(nullif(job_url, ''), concat_ws('|', coalesce(title, ''), coalesce(company, ''))) "
             f"AS url_key FROM ({R.JOBS})")
    kept = S.keep_first(keyed, ["url_key"], ["scraped_at"], R.JOB_COLUMNS + ["url_key"])
    return f"SELECT url_key, title, company, scraped_at FROM ({kept})"


@register("jobs_url_dedupe", sql=_sql_jobs_url_dedupe, ops="U4")
def q_jobs_url_dedupe(spark, sf_dir):
    """U4: postings keyed by URL (else title|company), the earliest scraped kept."""
    from laborlens.operators.dedupe import fallback_key, keep_first
    jobs = tables.job_postings(spark, sf_dir).withColumn("url_key", fallback_key("job_url", "title", "company"))
    return keep_first(jobs, ["url_key"], ["scraped_at"]).select("url_key", "title", "company", "scraped_at")


TRACKER_URL = "https://tracker.example/"


def tracker_news(spark, sf_dir):
    """Tracker rows (A9) in the news record shape: one site-root URL for all of them."""
    t = tracker_rows(spark, sf_dir)
    return t.select("title", "description", "company", "city", F.col("headcount").cast("string").alias("headcount"),
                    F.lit("layoff").alias("signal_type"), F.col("date").alias("published_at"), F.lit(TRACKER_URL).alias("url"),
                    F.lit("tracker").alias("source_name"), F.lit("tracker").alias("source"),
                    F.lit("2024-01-31T06:00:00Z").alias("scraped_at"))


@register("news_all_origins", sql=lambda: f"""
SELECT url_key, title, source, n_sources FROM (
  SELECT *, count(*) OVER (PARTITION BY url_key) AS n_sources,
         row_number() OVER (PARTITION BY url_key ORDER BY scraped_at, title, source) AS _rn
  FROM (SELECT {S.news_url_key('url', 'title', 'company')} AS url_key, title, source, scraped_at FROM (
    SELECT title, url, company, source, scraped_at FROM ({R.NEWS})
    UNION ALL
    SELECT title, '{TRACKER_URL}' AS url, company, 'tracker' AS source, '2024-01-31T06:00:00Z' AS scraped_at
    FROM ({_sql_tracker()}))))
WHERE _rn = 1""", ops="T2 U2 A9")
def q_news_all_origins(spark, sf_dir):
    """T2 + U2: API and feed news unioned with tracker rows by name, then one row
    per URL key; the tracker's shared root URL is qualified by the title, so its
    rows are not collapsed into one (``n_sources`` counts the copies merged)."""
    from laborlens.operators.dedupe import keep_first, news_url_key
    news = tables.news_signals(spark, sf_dir).unionByName(tracker_news(spark, sf_dir), allowMissingColumns=True)
    keyed = news.select(news_url_key("url", "title", "company").alias("url_key"), "title", "source", "scraped_at")
    counts = keyed.groupBy("url_key").agg(F.count(F.lit(1)).alias("n_sources"))
    return keep_first(keyed, ["url_key"], ["scraped_at", "title", "source"]).join(counts, "url_key") \
        .select("url_key", "title", "source", "n_sources")


_TRACKER_NEWS_SQL = f"""
SELECT t.title, t.description, t.company, t.city, t.headcount, 'layoff' AS signal_type,
       strftime(DATE '2023-12-22' + CAST(s.s_suppkey % 40 AS INT), '%Y-%m-%d') AS published_at, '{TRACKER_URL}' AS url,
       'tracker' AS source_name, 'tracker' AS source, '2024-01-31T06:00:00Z' AS scraped_at
FROM ({_TRACKER_SQL}) t JOIN supplier s ON t.company = s.s_name"""
_ALL_NEWS_SQL = " UNION ALL ".join(f"SELECT {', '.join(R.NEWS_COLUMNS)} FROM ({src})" for src in (R.NEWS, _TRACKER_NEWS_SQL))


@register("tracker_silver_news", sql=lambda: f"""
SELECT url_key, title, company_norm, city, headcount, strftime(published_ts, '%Y-%m-%d') AS day, source
FROM ({R.silver_news(dic(), NEWS_AS_OF).replace(R.NEWS, _ALL_NEWS_SQL)})""",
          ops="A9 T2 U2 B6 Y2")
def q_tracker_silver(spark, sf_dir):
    """Tracker rows beside the other news through the silver plan: dated by their
    own cell, those outside the window dropped."""
    from laborlens.plans import silver
    news = tables.news_signals(spark, sf_dir)
    both = news.withColumn("headcount", F.col("headcount").cast("string")).unionByName(tracker_news(spark, sf_dir))
    return silver.news(both, dic(), ts(NEWS_AS_OF)).select(
        "url_key", "title", "company_norm", "city", "headcount", F.date_format("published_ts", "yyyy-MM-dd").alias("day"), "source")
