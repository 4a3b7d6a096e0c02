"""Served documents (K4-K9) as distributed writes.

A document that lists every city or company is written as JSON lines (one
element per line, written by all tasks) plus a one-line header with the
document-level fields; nothing is gathered into one task or the driver.
Per-city company lists are split into pages of bounded size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlens.functions.text import slug

PIPELINE_VERSION = "0.2.0"  # of this package
ENGINE = "spark-native"

CITY_FIELDS = ["city", "lat", "lng", "total_hiring", "total_layoffs", "total_companies", "it_companies",
               "hiring_companies", "layoff_companies", "avg_sentiment", "growth_score"]
INT_FIELDS = ["total_hiring", "total_layoffs", "total_companies", "it_companies", "hiring_companies",
              "layoff_companies"]


def clean_for_export(df: DataFrame, int_fields=INT_FIELDS, round_fields=("avg_sentiment",), digits: int = 3) -> DataFrame:
    """K9: null counts -> 0, null strings -> "", means rounded (types stay typed)."""
    out = df
    for c, t in df.dtypes:
        if c in int_fields:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
        elif c in round_fields:
            out = out.withColumn(c, F.round(F.nanvl(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0)), digits))
        elif t == "string":
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit("")))
    return out


def write_city_summary(cities: DataFrame, path: str, run_ts: str, updated_at: str) -> None:
    """K4: ``districts`` lines + ``header`` line {updated_at, run_ts, district_count}."""
    rows = clean_for_export(cities.select(*CITY_FIELDS)).withColumn("updated_at", F.lit(updated_at))
    rows.write.mode("overwrite").json(f"{path}/districts")
    written = cities.sparkSession.read.schema(rows.schema).json(f"{path}/districts")  # counted as written: computed once
    header = written.agg(F.count(F.lit(1)).alias("district_count")).select(
        F.lit(updated_at).alias("updated_at"), F.lit(run_ts).alias("run_ts"), "district_count")
    header.coalesce(1).write.mode("overwrite").json(f"{path}/header")


CITY_SCHEMA = T.StructType([T.StructField("city", T.StringType()), T.StructField("lat", T.DoubleType()),
                            T.StructField("lng", T.DoubleType())]
                           + [T.StructField(c, T.LongType()) for c in INT_FIELDS]
                           + [T.StructField("avg_sentiment", T.DoubleType()), T.StructField("growth_score", T.DoubleType()),
                              T.StructField("updated_at", T.StringType())])


def read_city_summary(spark: SparkSession, path: str) -> DataFrame:
    """A10: read the document back: district lines with the header's count
    attached (the header is exactly one line, read as a single value)."""
    districts = spark.read.schema(CITY_SCHEMA).json(f"{path}/districts")
    header = spark.read.schema("updated_at string, run_ts string, district_count long").json(f"{path}/header")
    count = header.select("district_count").first()[0]
    return districts.drop("updated_at").withColumn("district_count", F.lit(count).cast("bigint"))


def city_company_pages(gold_company: DataFrame, page_size: int = 1000) -> DataFrame:
    """K5 + G8: companies per city as pages of about ``page_size`` (page =
    hash(company) mod ceil(n/page_size)); a city holding a third of all
    companies becomes many pages, never one giant list."""
    g = gold_company.withColumn("city_slug", slug("city"))
    sizes = g.groupBy("city_slug").agg(F.count(F.lit(1)).alias("_n"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(page_size)))
    paged = g.join(sizes, "city_slug").withColumn("page", F.pmod(F.xxhash64("company_norm"), pages).cast("int"))
    rec = F.struct("company_norm", "city", "sector", "company_status", "open_positions", "total_layoffs")
    return paged.groupBy("city_slug", "page").agg(F.array_sort(F.collect_list(rec)).alias("companies"))


def write_city_pages(pages: DataFrame, path: str) -> None:
    """K5: one directory per city slug, one JSON line per page."""
    pages.write.mode("overwrite").partitionBy("city_slug").json(path)


def run_meta(companies: DataFrame, cities: DataFrame, run_ts: str, updated_at: str,
             new_flag: str | None = None, name_col: str = "company_norm") -> DataFrame:
    """K8 + G9: one row of run counts (companies, distinct names, districts and,
    given an ``is_new`` column, new companies): one aggregate over the companies,
    one over the cities, joined as two one-row relations on a constant key."""
    aggs = [F.count(F.lit(1)).alias("total_companies"), F.countDistinct(name_col).alias("unique_companies")]
    if new_flag is not None:
        aggs.append(F.count_if(F.col(new_flag)).alias("new_companies"))
    one = F.lit(1).alias("one")
    co = companies.agg(*aggs).select("*", one)
    row = co.join(cities.agg(F.count(F.lit(1)).alias("total_districts")).select("*", one), "one")
    metrics = [a for a in ("total_companies", "unique_companies", "new_companies") if a in co.columns] + ["total_districts"]
    return row.select(F.lit(updated_at).alias("updated_at"), F.lit(run_ts).alias("run_ts"), *metrics,
                      F.lit(PIPELINE_VERSION).alias("pipeline_version"), F.lit(ENGINE).alias("engine"))


def write_lines_document(rows: DataFrame, path: str, run_ts: str, updated_at: str, new_flag: str | None = None) -> None:
    """K6 / K7: a document of many elements: ``rows`` as JSON lines (all tasks write) and
    a one-line ``header`` {updated_at, run_ts, total[, new_this_run]}."""
    rows.write.mode("overwrite").json(f"{path}/rows")
    counts = [F.count(F.lit(1)).alias("total")]
    if new_flag is not None:
        counts.append(F.count_if(F.col(new_flag)).alias("new_this_run"))
    written = rows.sparkSession.read.schema(rows.schema).json(f"{path}/rows")  # counted as written: computed once
    header = written.agg(*counts).select(F.lit(updated_at).alias("updated_at"), F.lit(run_ts).alias("run_ts"), "*")
    header.coalesce(1).write.mode("overwrite").json(f"{path}/header")


def read_lines_document(spark: SparkSession, path: str, rows_schema) -> DataFrame:
    """A10: the document's rows with its header's counts (null where the header has none)."""
    header = spark.read.schema("total long, new_this_run long").json(f"{path}/header").first()  # one line
    return spark.read.schema(rows_schema).json(f"{path}/rows").withColumns(
        {"total": F.lit(header.total).cast("bigint"), "new_this_run": F.lit(header.new_this_run).cast("bigint")})


def read_city_pages(spark: SparkSession, path: str) -> DataFrame:
    """A10: the pages as they were written, one row per company."""
    rec = ("company_norm string, city string, sector string, company_status string, open_positions long, "
           "total_layoffs long")
    pages = spark.read.schema(f"page int, companies array<struct<{rec.replace(' ', ':').replace(',:', ',')}>>, "
                              "city_slug string").json(path)
    return pages.select("city_slug", "page", F.explode("companies").alias("c")).select("city_slug", "page", "c.*")
