"""Signal scoring and company status (Y4-Y7), as CASE expressions.

Scores are multiples of 0.1, so they are carried as integer tenths and the
status thresholds are compared on exact integer sums: the outcome cannot
depend on floating-point summation order (which differs between engines and
between partitionings).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laborlens.functions import dictionaries as D
from laborlens.functions.text import classify_sector, safe_int


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def _tenths(x: float) -> int:
    return int(round(x * 10))


def signal_score_tenths(signal_type: Column | str, headcount: Column | str) -> Column:
    """Y4 in tenths: +-10 / 8 / 6 / 4 by headcount band (> 5000 / > 1000 / > 100 /
    else) for hiring / layoff, 0 otherwise; a headcount may be a number or text
    ("1,200", "5000.0"), anything else counts as 0."""
    return tenths_of_count(signal_type, safe_int(headcount))


def tenths_of_count(signal_type: Column | str, count: Column | str) -> Column:
    """Y4 in tenths from a headcount that is read already (``parse_count``; null counts as 0)."""
    t, hc = _c(signal_type), F.coalesce(_c(count), F.lit(0))
    mag = None
    for bound, value in D.SCORE_BANDS:
        v = F.lit(_tenths(value))
        mag = F.when(hc > bound, v) if mag is None else mag.when(hc > bound, v)
    mag = mag.otherwise(F.lit(_tenths(D.SCORE_FLOOR)))
    return F.when(t == "layoff", -mag).when(t == "hiring", mag).otherwise(F.lit(0))


def signal_score(signal_type: Column | str, headcount: Column | str) -> Column:
    """The score as a double (tenths / 10)."""
    return signal_score_tenths(signal_type, headcount) / F.lit(10.0)


def status_from_sums(score_tenths_sum: Column | str, n: Column | str) -> Column:
    """Y5 on exact sums: mean < -0.3 layoff, mean > 0.3 hiring, else (no articles too) mixed."""
    s, n = F.coalesce(_c(score_tenths_sum), F.lit(0)), F.coalesce(_c(n), F.lit(0))
    lo, hi = _tenths(D.STATUS_LAYOFF_BELOW), _tenths(D.STATUS_HIRING_ABOVE)
    return (F.when((n > 0) & (s < n * lo), "layoff")
            .when((n > 0) & (s > n * hi), "hiring").otherwise("mixed"))


def company_status(score_tenths_sum, n, layoff_articles, hiring_articles) -> Column:
    """Y6 over Y5: an article count more than double the other side's overrides
    the sentiment status (with non-negative counts at most one side can hold)."""
    lay, hire = _c(layoff_articles), _c(hiring_articles)
    return (F.when(hire > lay * 2, "hiring")
            .when(lay > hire * 2, "layoff")
            .otherwise(status_from_sums(score_tenths_sum, n)))


def mean_score(score_tenths_sum: Column | str, n: Column | str) -> Column:
    """Mean score as a double from exact sums (0.0 with no articles)."""
    n = _c(n)
    return F.when(n > 0, _c(score_tenths_sum) / (n * F.lit(10.0))).otherwise(F.lit(0.0))


def choose_sector(register_sector: Column | str, company: Column | str, groups=D.SECTOR_KEYWORDS) -> Column:
    """Keep the register sector unless it is null/""/"nan"/"Other", else classify the name."""
    s = _c(register_sector)
    return F.when(s.isNull() | s.isin(*D.EMPTY_SECTORS), classify_sector(company, None, groups)).otherwise(s)
