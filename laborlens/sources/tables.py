"""Record roles over the driver's generated tables.

The landed sources (job boards, news, payroll API, company register) are
represented by deterministic projections of the star-schema tables, so every
job's work grows with the tables:

* job posting  = lineitem x orders x customer x nation x part
* news signal  = events (x customer x nation for the city)
* register     = supplier rows (API shape) + customer rows (curated-seed shape)
* payroll raw  = orders per region and month, with field spellings varying by region

Joins are plain equi-joins; Catalyst prunes columns to what each query reads
and pushes filters into the scans; small sides are broadcast by the engine's own
size check only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens.session import table_path

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"
RFC822_OUT = "EEE, dd MMM yyyy HH:mm:ss 'GMT'"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A generated table, read as it lies (split sizes are the session's)."""
    return spark.read.parquet(table_path(sf_dir, name))


def job_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze job records (JOB schema order)."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate",
                                                "l_extendedprice")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    # the orders get their customer before they meet the line items, which are thus moved twice, while few columns wide
    placed = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    j = li.join(p, li.l_partkey == p.p_partkey).join(placed, li.l_orderkey == placed.o_orderkey)
    return j.select(
        F.col("p_name").alias("title"),
        F.col("c_name").alias("company"),
        F.col("n_name").alias("location"),
        F.lower("n_name").alias("city_key"),
        F.lit(None).cast("string").alias("experience"),
        F.when(F.col("o_orderstatus") == "F",
               F.round("l_extendedprice").cast("bigint").cast("string")).alias("salary"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("posted_date"),
        F.concat(F.lit("https://jobs.example/"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("job_url"),
        F.when(F.col("o_orderstatus") == "F", "board_a").otherwise("board_b").alias("source"),
        F.date_format("l_shipdate", ISO_Z).alias("scraped_at"))


def news_signals(spark: SparkSession, sf_dir: str, keep_id: bool = False) -> DataFrame:
    """Bronze news records (NEWS schema order; ``keep_id`` appends the event id)."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = (e.join(c, e.user_id == c.c_custkey, "left")
         .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    company = F.format_string("Customer#%09d", F.col("user_id"))
    signal = (F.when(F.col("event_type") == "error", "layoff")
              .when(F.col("event_type").isin("signup", "purchase"), "hiring").otherwise("neutral"))
    headcount = F.when(signal != "neutral", F.floor(F.col("value") * 20).cast("bigint"))
    hc = headcount.cast("string")
    title = F.concat(company, F.lit(" "), F.when(F.col("event_type") == "error",
                                                 F.concat(F.lit("layoff: "), hc, F.lit(" employees laid off")))
                     .when(F.col("event_type") == "signup", F.concat(F.lit("is hiring "), hc, F.lit(" freshers")))
                     .when(F.col("event_type") == "purchase", F.lit("announces mass hiring"))
                     .when(F.col("event_type") == "click", F.lit("posts quarterly results"))
                     .otherwise(F.lit("opens a new office")))
    published = F.when(F.col("event_type") == "click", F.date_format("ts", RFC822_OUT)) \
        .otherwise(F.date_format("ts", ISO_Z))
    url = F.concat(F.lit("https://news.example/"), F.col("user_id").cast("string"), F.lit("/"),
                   F.col("event_type"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd"))
    return j.select(
        title.alias("title"),
        F.col("props").alias("description"),
        company.alias("company"),
        F.col("n_name").alias("city"),
        headcount.alias("headcount"),
        signal.alias("signal_type"),
        published.alias("published_at"),
        url.alias("url"),
        F.concat(F.lit("feed_"), F.col("event_type")).alias("source_name"),
        F.when(F.col("event_type") == "click", "rss").otherwise("api").alias("source"),
        F.date_format("ts", ISO_Z).alias("scraped_at"),
        *([F.col("event_id")] if keep_id else []))


def raw_record(*pairs) -> "F.Column":
    """A loosely keyed raw record as ``map<string,string>`` without the null entries
    (an absent key, as in the landed JSON). Keys are exact and case-sensitive."""
    m = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v.cast("string"))])
    return F.map_filter(m, lambda k, v: v.isNotNull())


def register_api_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register API records as raw maps (``rec``): offices in the first three
    regions send lower-case field names, the others the upper-case spellings."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    up = F.col("n_regionkey") >= 3
    roc = F.concat(F.lit("RoC-"), F.col("n_name"))
    cin = F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
    rec = raw_record(
        ("company_name", F.when(~up, F.col("s_name"))), ("COMPANY_NAME", F.when(up, F.col("s_name"))),
        ("company_status", F.when(~up, F.lit("active"))), ("STATUS", F.when(up, F.lit("ACTIVE"))),
        ("roc_code", F.when(~up, roc)), ("ROC_CODE", F.when(up, roc)),
        ("state_name", F.lower("r_name")),
        ("cin", F.when(~up, F.concat(F.lit("U"), cin))), ("CIN", F.when(up, F.concat(F.lit("L"), cin))))
    return j.select(rec.alias("rec"))


def register_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated-seed shaped register rows from the customer table (sector = market segment)."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    from laborlens.functions.text import title_case
    return j.select(
        F.col("c_name").alias("name"),
        F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("cin_prefix"),
        title_case(F.col("r_name")).alias("state"),
        F.col("n_name").alias("city"),
        title_case(F.col("c_mktsegment")).alias("sector"),
        F.lit("Active").alias("status"),
        F.lit("").alias("incorporation_year"),
        F.lit("").alias("authorized_capital"),
        F.lit("").alias("paid_up_capital"),
        F.lit("curated_seed").alias("source"),
        F.lit("2024-01-01T00:00:01Z").alias("scraped_at"))


PAYROLL_STATE_FIELDS = ["state_name", "State", "state", "STATE"]
PAYROLL_MONTH_FIELDS = ["month", "Month", "payroll_month"]
PAYROLL_VALUE_FIELDS = ["new_subscribers", "payroll_addition", "count", "value", "total"]


def payroll_api_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payroll API records as raw maps (``rec``): new subscriptions = orders per
    region and month.

    Region k writes its state under spelling k of the state fields (region 4
    sends an empty ``state_name`` and fills ``State``: the empty string must be
    skipped), its value under value spelling k (regions 1 and 3 with thousands
    separators) and its month under one of the three month spellings.
    """
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    agg = (o.join(c, o.o_custkey == c.c_custkey)
           .join(n, F.col("c_nationkey") == n.n_nationkey)
           .join(r, F.col("n_regionkey") == r.r_regionkey)
           .groupBy("r_regionkey", "r_name", F.date_format("o_orderdate", "yyyy-MM").alias("ym"))
           .agg(F.count(F.lit(1)).alias("n")))
    k = F.col("r_regionkey")
    state_text = F.concat(F.lit(" "), F.lower("r_name"), F.lit(" "))
    value_text = F.when(k.isin(1, 3), F.format_number(F.col("n") * 1000, 0)).otherwise((F.col("n") * 1000).cast("string"))
    pairs = [("state_name", F.when(k == 0, state_text).when(k == 4, F.lit(""))),
             ("State", F.when((k == 1) | (k == 4), state_text)),
             ("state", F.when(k == 2, state_text)),
             ("STATE", F.when(k == 3, state_text))]
    month_field_of_region = {0: "month", 1: "Month", 2: "payroll_month", 3: "month", 4: "Month"}
    pairs += [(f, F.when(k.isin(*[r for r, g in month_field_of_region.items() if g == f]), F.col("ym")))
              for f in PAYROLL_MONTH_FIELDS]
    pairs += [(f, F.when(k == i, value_text)) for i, f in enumerate(PAYROLL_VALUE_FIELDS)]
    return agg.select(raw_record(*pairs).alias("rec"))


def region_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(state, cities): each region's nations in key order - the fixture state -> city map.
    25 rows in, 5 rows out."""
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    from laborlens.functions.text import title_case
    grouped = (n.join(r, n.n_regionkey == r.r_regionkey)
               .groupBy("r_name")
               .agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("_c")))
    return grouped.select(title_case(F.col("r_name")).alias("state"),
                          F.transform("_c", lambda e: e.getField("n_name")).alias("cities"))
