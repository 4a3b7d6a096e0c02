"""Bronze -> silver: normalise, parse, score, filter, dedupe (B*, U*, X1/X2, Y1-Y4).

Every function is lazy; company and city normalisation run once per
distinct (name, raw city) pair (``map_distinct``); everything else is a
per-row codegen expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.functions import dictionaries as D
from laborlens.functions.dates import cutoff_date, parse_iso_date, parse_published
from laborlens.functions.scoring import tenths_of_count
from laborlens.functions.similarity import with_company_norm
from laborlens.functions.text import (classify_register_sector, first_nonempty, normalise_city, parse_count, strip_ws,
                                      title_case)
from laborlens.operators.dedupe import keep_first, news_url_key
from laborlens.operators.lookup import map_distinct


@dataclass(frozen=True)
class Dictionaries:
    canonical: tuple[str, ...] = tuple(D.CANONICAL_COMPANIES)
    cutoff: float = D.COMPANY_MATCH_CUTOFF
    city_aliases: tuple[tuple[str, str], ...] = tuple(D.CITY_ALIASES)
    sectors: tuple = tuple(D.SECTOR_KEYWORDS)
    register_sectors: tuple = tuple(D.REGISTER_SECTOR_KEYWORDS)
    roc_states: tuple[tuple[str, str], ...] = tuple(D.ROC_STATE)
    it_sector: str = D.IT_SECTOR


def fixture_dictionaries() -> Dictionaries:
    """Fixed dictionaries extended with the rule-built fixture entries (fixture keys first)."""
    return Dictionaries(
        canonical=tuple(D.CANONICAL_COMPANIES + D.fixture_canonical_names()),
        city_aliases=tuple(D.fixture_city_aliases() + D.CITY_ALIASES),
        sectors=tuple(D.SECTOR_KEYWORDS + D.fixture_sector_keywords()),
        register_sectors=tuple(D.REGISTER_SECTOR_KEYWORDS + D.fixture_sector_keywords()),
        roc_states=tuple(D.fixture_roc_states() + D.ROC_STATE),
    )


def company_norm(df: DataFrame, col: str, out: str, dic: Dictionaries, min_len: int = 2) -> DataFrame:
    """X1 + J7 per distinct value, joined back."""
    return map_distinct(df, col, lambda k: with_company_norm(k, "_k0", out, dic.canonical, dic.cutoff, min_len), out)


def company_and_city(df: DataFrame, company: str, city_raw: str, dic: Dictionaries, company_out: str,
                     city_out: str, min_len: int = 2) -> DataFrame:
    """X1 + X2 once per distinct (company, raw city) pair, one join back."""
    def fn(k: DataFrame) -> DataFrame:
        named = with_company_norm(k, "_k0", company_out, dic.canonical, dic.cutoff, min_len)
        return named.withColumn(city_out, normalise_city("_k1", dic.city_aliases))
    return map_distinct(df, [company, city_raw], fn, [company_out, city_out])


def jobs(bronze: DataFrame, dic: Dictionaries) -> DataFrame:
    """Silver job postings: company_norm, city, typed posted_date, one row per
    (company_norm, title, city) - the earliest scraped, then smallest URL."""
    df = bronze.withColumn("_city_raw", F.coalesce(F.nullif(F.col("city_key"), F.lit("")), F.col("location")))
    df = company_and_city(df, "company", "_city_raw", dic, "company_norm", "city")
    df = (df.withColumn("posted_date", parse_iso_date("posted_date"))
          .drop("_city_raw")
          .where(F.length("company_norm") > 2))
    return keep_first(df, ["company_norm", "title", "city"], ["scraped_at", "job_url"])


def recent_jobs(silver_jobs: DataFrame, as_of: Column, recent_days: int = 0) -> DataFrame:
    """``is_recent`` = posted on or after as_of - recent_days, then filtered."""
    return (silver_jobs.withColumn("is_recent", F.col("posted_date") >= F.date_sub(F.to_date(as_of), recent_days))
            .where("is_recent"))


def news(bronze: DataFrame, dic: Dictionaries, as_of: Column, window_days: int = 30) -> DataFrame:
    """Silver news: known signal types (B5), parsed dates (Y2, unparsed dropped),
    inside the window (B6), scored (Y4), one row per URL key (U2: URL, or
    title|company when the URL is empty) keeping the earliest scraped."""
    df = company_and_city(bronze.withColumnRenamed("city", "_city_raw"), "company", "_city_raw", dic,
                          "company_norm", "city")
    cols = [c if c != "_city_raw" else "city" for c in bronze.columns] + ["company_norm"]
    df = (df.select(*cols)
          .where(F.col("signal_type").isin(*D.SIGNAL_TYPES))
          .withColumns({"published_ts": parse_published("published_at"), "headcount": parse_count("headcount")})
          # an unparsed date is null and thus outside: one condition, as each parses the text anew in the scan
          .where(F.to_date("published_ts") >= cutoff_date(as_of, window_days))
          .withColumn("score_tenths", tenths_of_count("signal_type", "headcount"))
          .withColumns({"signal_score": F.col("score_tenths") / F.lit(10.0),
                        "url_key": news_url_key("url", "title", "company")}))
    return keep_first(df, ["url_key"], ["scraped_at", "published_ts", "title"])


def unparsed_news(bronze: DataFrame) -> DataFrame:
    """One row: the news rows of a known signal type that ``news`` drops because
    their date can't be parsed (Y2)."""
    unparsed = F.col("signal_type").isin(*D.SIGNAL_TYPES) & parse_published("published_at").isNull()
    return bronze.agg(F.count_if(unparsed).alias("unparsed_dates"))


def field(rec: str, key: str) -> Column:
    """Exact-key lookup in a raw record map (absent -> null)."""
    return F.try_element_at(F.col(rec), F.lit(key))


def register_from_api(raw: DataFrame, dic: Dictionaries, rec: str = "rec") -> DataFrame:
    """Register API rows (raw maps) -> REGISTER shape: spellings coalesced (B2),
    name and status title-cased, state from the office code else the state name
    (J5), sector classified from the name (X4); rows without a name dropped (B8)."""
    f = lambda k: field(rec, k)
    name = title_case(strip_ws(F.coalesce(first_nonempty(f("company_name"), f("COMPANY_NAME"), f("name")), F.lit(""))))
    status = title_case(strip_ws(F.coalesce(first_nonempty(f("company_status"), f("STATUS")), F.lit("Unknown"))))
    roc = strip_ws(F.coalesce(first_nonempty(f("roc_code"), f("ROC_CODE")), F.lit("")))
    state = first_contained_exact(roc, dic.roc_states, title_case(strip_ws(F.coalesce(f("state_name"), F.lit("")))))
    e = F.lit("")
    out = raw.select(
        name.alias("name"),
        F.coalesce(first_nonempty(f("cin"), f("CIN")), e).alias("cin"),
        F.lit(None).cast("string").alias("cin_prefix"),
        status.alias("status"),
        F.coalesce(first_nonempty(f("company_class"), f("CLASS")), e).alias("class"),
        F.coalesce(first_nonempty(f("company_category"), f("CATEGORY")), e).alias("category"),
        state.alias("state"),
        e.alias("city"),
        roc.alias("roc"),
        F.coalesce(first_nonempty(f("date_of_incorporation"), f("DATE_OF_INCORP")), e).alias("incorporation_date"),
        F.lit(None).cast("string").alias("incorporation_year"),
        F.coalesce(first_nonempty(f("authorized_capital"), f("AUTHORIZED_CAP")), e).alias("authorized_capital"),
        F.coalesce(first_nonempty(f("paidup_capital"), f("PAIDUP_CAP")), e).alias("paid_up_capital"),
        F.lit("api").alias("source"),
        F.lit("2024-01-01T00:00:00Z").alias("scraped_at"))
    out = out.withColumn("sector", classify_register_sector("name", dic.register_sectors))
    return out.where(F.col("name") != "")


def first_contained_exact(key: Column, pairs, default: Column) -> Column:
    """Exact-key dictionary lookup as a CASE chain (J5; the dictionary is code-sized)."""
    out = None
    for k, v in pairs:
        out = F.when(key == F.lit(k), F.lit(v)) if out is None else out.when(key == F.lit(k), F.lit(v))
    return default if out is None else out.otherwise(default)


def register(bronze: DataFrame, dic: Dictionaries) -> DataFrame:
    """Silver register: name_norm (X1), city (X2), one row per name_norm keeping
    the first landed (API rows before curated seed rows, then by name) (U3)."""
    df = company_and_city(bronze.withColumnRenamed("city", "_city_raw"), "name", "_city_raw", dic,
                          "name_norm", "city")
    cols = [c if c != "_city_raw" else "city" for c in bronze.columns] + ["name_norm"]
    return keep_first(df.select(*cols), ["name_norm"], ["scraped_at", "name"])
