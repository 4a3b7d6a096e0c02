"""Declared schemas for every landed record shape (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

JOB = T.StructType([T.StructField(c, S) for c in [
    "title", "company", "location", "city_key", "experience", "salary",
    "posted_date", "job_url", "source", "scraped_at"]])

NEWS = T.StructType([
    T.StructField("title", S), T.StructField("description", S), T.StructField("company", S),
    T.StructField("city", S), T.StructField("headcount", S),
    T.StructField("signal_type", S), T.StructField("published_at", S), T.StructField("url", S),
    T.StructField("source_name", S), T.StructField("source", S), T.StructField("scraped_at", S)])

PAYROLL = T.StructType([
    T.StructField("state", S), T.StructField("city", S), T.StructField("metric", S),
    T.StructField("value", T.LongType()), T.StructField("month", S),
    T.StructField("raw_state_val", T.LongType()), T.StructField("source", S), T.StructField("scraped_at", S)])

# Union of the register shapes: API rows (cin, incorporation_date, ...) and
# curated seed rows (cin_prefix, incorporation_year).
REGISTER = T.StructType([T.StructField(c, S) for c in [
    "name", "cin", "cin_prefix", "status", "class", "category", "state", "city", "roc",
    "incorporation_date", "incorporation_year", "authorized_capital", "paid_up_capital",
    "sector", "source", "scraped_at"]])

# Loosely named raw payroll / register API records (B2/B3 coalesce over spellings).
PAYROLL_RAW = T.StructType([T.StructField(c, S) for c in [
    "state_name", "State", "state", "STATE", "month", "Month", "payroll_month",
    "new_subscribers", "payroll_addition", "count", "value", "total", "no_of_employees"]])

REGISTER_RAW = T.StructType([T.StructField(c, S) for c in [
    "company_name", "COMPANY_NAME", "name", "company_status", "STATUS", "roc_code", "ROC_CODE",
    "state_name", "cin", "CIN", "company_class", "CLASS", "company_category", "CATEGORY",
    "date_of_incorporation", "DATE_OF_INCORP", "authorized_capital", "AUTHORIZED_CAP",
    "paidup_capital", "PAIDUP_CAP"]])


def envelope(record: T.StructType, array_field: str) -> T.StructType:
    """Bronze envelope: batch stamps + one array of records (``jobs`` or ``records``)."""
    return T.StructType([
        T.StructField("batch_ts", S), T.StructField("run_id", S), T.StructField("city", S),
        T.StructField("source", S), T.StructField("chunk", T.IntegerType()),
        T.StructField("job_count", T.IntegerType()), T.StructField("record_count", T.IntegerType()),
        T.StructField(array_field, T.ArrayType(record))])


def any_envelope(record: T.StructType) -> T.StructType:
    """Envelope that accepts either array name (A2: ``records`` else ``jobs``)."""
    base = envelope(record, "records")
    return base.add(T.StructField("jobs", T.ArrayType(record)))


# Gold long-form history state.
HISTORY = T.StructType([
    T.StructField("company", S), T.StructField("city", S), T.StructField("date", S),
    T.StructField("hiring", T.LongType()), T.StructField("layoffs", T.LongType()),
    T.StructField("score", T.LongType())])
