"""Date column functions (Y1-Y3). The reference date is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RELATIVE_PATTERN = r"(?i)(\d+)\s*(day|hour|week|month)"
ISO_Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
RFC822_FORMAT = "dd MMM yyyy HH:mm:ss zzz"  # after the "Www, " weekday prefix is dropped
ISO_START = r"^\d{4}-\d{2}-\d{2}($|[T ])"
US_DATE_FORMAT = "M/d/yyyy"
RFC822_OFFSET_FORMAT = "dd MMM yyyy HH:mm:ss Z"  # numeric offsets such as +0530


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def relative_date(text: Column | str, as_of: Column) -> Column:
    """Y1: "<n> day|hour|week|month" (anywhere, any case) -> ISO date of
    ``as_of`` minus that span (a month is 30 days; hours move the timestamp);
    no match -> the text unchanged; null/"" -> ""."""
    text = _c(text)
    n = F.regexp_extract(text, RELATIVE_PATTERN, 1).try_cast("int")
    unit = F.lower(F.regexp_extract(text, RELATIVE_PATTERN, 2))
    day = F.to_date(as_of)
    shifted = (F.when(unit == "hour", F.to_date(as_of - F.make_dt_interval(hours=n)))
               .when(unit == "day", F.date_sub(day, n))
               .when(unit == "week", F.date_sub(day, n * 7))
               .when(unit == "month", F.date_sub(day, n * 30)))
    return (F.when(text.isNull() | (text == ""), F.lit(""))
            .when(unit == "", text)
            .otherwise(F.date_format(shifted, "yyyy-MM-dd")))


def parse_published(col: Column | str) -> Column:
    """Y2: ISO-8601 (a date alone, or with a time, a fraction, "Z" or an offset),
    RFC-822 ("Fri, 05 Jan 2024 10:11:12 GMT", or with a numeric offset such as
    +0530), or month/day/year -> timestamp; anything else -> null. The ``try_``
    forms keep ANSI mode from raising; the weekday is cut off because pattern
    letter E is not parseable. A text that misses its format costs many times one
    that fits, so a text with a weekday is not tried as a numeric form, which
    begins with a digit or a sign."""
    s = F.trim(_c(col))
    weekday = s.rlike(r"^[A-Za-z]{3}, ")
    rfc_body = F.regexp_replace(s, r"^[A-Za-z]{3}, ", "")
    return F.when(weekday, F.coalesce(F.try_to_timestamp(rfc_body, F.lit(RFC822_FORMAT)),
                                      F.try_to_timestamp(rfc_body, F.lit(RFC822_OFFSET_FORMAT)))) \
        .otherwise(F.coalesce(F.try_to_timestamp(s, F.lit(ISO_Z_FORMAT)),
                              F.when(s.rlike(ISO_START), s.try_cast("timestamp")),
                              F.try_to_timestamp(s, F.lit(US_DATE_FORMAT))))


def parse_iso_date(col: Column | str) -> Column:
    """Y2 for job postings: the date of any form that ``parse_published`` reads, else null."""
    s = _c(col)
    return F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.to_date(parse_published(s)))


def cutoff_date(as_of: Column, days: int = 30) -> Column:
    """First date still inside the window."""
    return F.date_sub(F.to_date(as_of), days)
