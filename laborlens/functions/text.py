"""Text column functions (normalise, classify, extract).

All built from ``pyspark.sql.functions``: ``CASE``/``contains`` chains and
``regexp_*`` stay inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from laborlens.functions import dictionaries as D


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: Column | str) -> Column:
    """Trim leading/trailing whitespace of any kind (``trim`` only drops spaces)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def title_case(col: Column | str) -> Column:
    """Title case with the word rule of the reproduced code.

    A cased character is upper-cased when the previous character is not cased
    and lower-cased otherwise, so ``byju's l&t`` -> ``Byju'S L&T`` and
    ``nation_7`` -> ``Nation_7``. ``initcap`` differs (it only looks at spaces).
    A character counts as cased when ``upper(c) != lower(c)``.
    """
    chars = F.split(F.lower(_c(col)), "")

    def fix(c, i):
        prev = F.element_at(chars, i)  # element_at is 1-based: index i is the previous char
        prev_cased = F.when(i == 0, F.lit(False)).otherwise(F.upper(prev) != F.lower(prev))
        return F.when(prev_cased, c).otherwise(F.upper(c))

    return F.when(_c(col).isNull(), F.lit(None)).otherwise(F.array_join(F.transform(chars, fix), ""))


def first_contained(text: Column, pairs: Sequence[tuple[str, str]], default: Column | None = None) -> Column:
    """Value of the first ``(key, value)`` whose key is a substring of ``text``."""
    out = None
    for key, value in pairs:
        cond = text.contains(F.lit(key))
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    if out is None:
        return default if default is not None else F.lit(None).cast("string")
    return out.otherwise(default) if default is not None else out


def normalise_city(raw: Column | str, aliases: Sequence[tuple[str, str]] = D.CITY_ALIASES) -> Column:
    """First alias (in list order) contained in the lower-trimmed text,
    else the trimmed text in title case; null/empty -> ""."""
    raw = _c(raw)
    key = F.lower(strip_ws(raw))
    return (F.when(raw.isNull() | (raw == ""), F.lit(""))
            .otherwise(first_contained(key, aliases, title_case(strip_ws(raw)))))


def classify_keywords(text: Column, groups: Sequence[tuple[str, Sequence[str]]],
                      default: str = D.SECTOR_DEFAULT) -> Column:
    """First group with any keyword contained in ``text`` (lower-cased by caller)."""
    out = None
    for label, words in groups:
        cond = None
        for w in words:
            c = text.contains(F.lit(w))
            cond = c if cond is None else (cond | c)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def classify_sector(name: Column | str, description: Column | str | None = None,
                    groups=D.SECTOR_KEYWORDS) -> Column:
    """Sector of ``name + " " + description`` (lower-cased)."""
    desc = F.lit("") if description is None else F.coalesce(_c(description), F.lit(""))
    text = F.lower(F.concat(F.coalesce(_c(name), F.lit("")), F.lit(" "), desc))
    return classify_keywords(text, groups)


def classify_register_sector(name: Column | str, groups=D.REGISTER_SECTOR_KEYWORDS) -> Column:
    """Sector of a register name (lower-cased)."""
    return classify_keywords(F.lower(F.coalesce(_c(name), F.lit(""))), groups)


def _count_present(text: Column, words: Sequence[str]) -> Column:
    total = F.lit(0)
    for w in words:
        total = total + F.when(text.contains(F.lit(w)), 1).otherwise(0)
    return total


def classify_signal(title: Column | str, description: Column | str,
                    layoff_words=D.LAYOFF_WORDS, hiring_words=D.HIRING_WORDS) -> Column:
    """Count distinct layoff vs hiring words present; larger wins, tie -> neutral."""
    text = F.lower(F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "),
                            F.coalesce(_c(description), F.lit(""))))
    lay = _count_present(text, layoff_words)
    hire = _count_present(text, hiring_words)
    return F.when(lay > hire, "layoff").when(hire > lay, "hiring").otherwise("neutral")


def _any_contains(text: Column, words: Sequence[str]) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | text.contains(F.lit(w))
    return cond


def extract_headcount(text: Column | str, patterns=D.HEADCOUNT_PATTERNS, guards=D.HEADCOUNT_GUARDS) -> Column:
    """First pattern (case-insensitive) that matches and converts; commas dropped.
    A pattern is only run on texts containing one of its required words."""
    text = _c(text)
    low = F.lower(text)
    outs = []
    for i, p in enumerate(patterns):
        grp = F.regexp_extract(text, "(?i)" + p, 1)
        hit = F.when(grp != "", F.regexp_replace(grp, ",", "").try_cast("bigint"))
        outs.append(F.when(_any_contains(low, guards[i]), hit) if guards is not None else hit)
    return F.coalesce(*outs)


def extract_company(text: Column | str, known=D.KNOWN_COMPANIES, patterns=D.COMPANY_PATTERNS,
                    stop=D.COMPANY_STOP_WORDS, guards=D.COMPANY_GUARDS) -> Column:
    """A known name contained (case-insensitive) in priority order, else the
    first pattern whose capture is not a stop word, else "". A pattern is only
    run on texts containing one of its required words (case-sensitive, as the
    patterns are)."""
    text = F.coalesce(_c(text), F.lit(""))
    low = F.lower(text)
    outs = [F.when(low.contains(F.lit(k.lower())), F.lit(k)) for k in known]
    for i, p in enumerate(patterns):
        grp = F.regexp_extract(text, p, 1)
        hit = F.when((grp != "") & ~grp.isin(*stop), grp)
        outs.append(F.when(_any_contains(text, guards[i]), hit) if guards is not None else hit)
    outs.append(F.lit(""))
    return F.coalesce(*outs)


def mention_pattern(cities: Sequence[str]) -> str:
    """One alternation, longest names first: the leftmost match wins and, at the
    same position, the first (longest) alternative - i.e. the earliest mention,
    then the longest name."""
    import re
    ordered = sorted(dict.fromkeys(cities), key=lambda c: (-len(c), c))
    return "(" + "|".join(re.escape(c) for c in ordered) + ")"


def extract_city(text: Column | str, cities=D.MENTION_CITIES) -> Column:
    """The city mentioned earliest (ties: the longest name), title-cased; else ""."""
    low = F.lower(F.coalesce(_c(text), F.lit("")))
    hit = F.regexp_extract(low, mention_pattern(cities), 1)
    return F.when(hit == "", F.lit("")).otherwise(title_case(hit))


def strip_html(col: Column | str, limit: int | None = None) -> Column:
    """Tags -> spaces, trimmed; ``limit`` cuts the served form of a long
    description (extractors take the whole text)."""
    text = strip_ws(F.regexp_replace(_c(col), "<[^>]+>", " "))
    return text if limit is None else F.substring(text, 1, limit)


def parse_count(col: Column | str) -> Column:
    """A count sent as a number or as text ("1,200", "5000.0"): commas dropped, read
    as a double, cut to a whole number; null for anything else (NaN too)."""
    d = F.regexp_replace(strip_ws(_c(col).cast("string")), ",", "").try_cast("double")
    return F.when(~F.isnan(d), d).try_cast("bigint")


def safe_int(col: Column | str, default: int = 0) -> Column:
    """``parse_count`` with a default for null, NaN and text."""
    return F.coalesce(parse_count(col), F.lit(default).cast("bigint"))


def safe_float(col: Column | str, default: float = 0.0) -> Column:
    """The value as a double; null, NaN and text become ``default``."""
    d = F.regexp_replace(strip_ws(_c(col).cast("string")), ",", "").try_cast("double")
    return F.coalesce(F.when(~F.isnan(d), d), F.lit(float(default)))


def digits_only(col: Column | str) -> Column:
    """Drop every non-digit and read the rest as a number (null if none)."""
    return F.regexp_replace(_c(col), "[^0-9]", "").try_cast("bigint")


def without_commas(col: Column | str) -> Column:
    """Strip, drop commas, read as a number (null if it does not parse)."""
    return F.regexp_replace(strip_ws(_c(col)), ",", "").try_cast("bigint")


def slug(col: Column | str, unknown: str = "Unknown") -> Column:
    """X11: lower case, spaces and slashes to underscores; null -> ``unknown``."""
    c = _c(col)
    return F.translate(F.lower(F.when(c.isNull() | (c == ""), F.lit(unknown)).otherwise(c)), " /", "__")


def layoff_headline(company: Column | str, headcount_raw: Column | str) -> Column:
    """Synthesised tracker headline."""
    return F.format_string("%s lays off %s employees", _c(company), _c(headcount_raw))


def tracker_description(*cols: Column | str) -> Column:
    """Fields joined by `` | ``."""
    return F.concat_ws(" | ", *[_c(c) for c in cols])


def url_host(url: Column | str) -> Column:
    """The third ``/``-separated part of a URL (the host for ``scheme://host/...``)."""
    return F.get(F.split(_c(url), "/"), 2)


def first_nonempty(*cols: Column | str) -> Column:
    """B2: first value that is neither null nor "" (the "truthy" rule)."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def first_int(*cols: Column | str) -> Column:
    """First candidate that parses as an integer after trimming and dropping commas."""
    return F.coalesce(*[without_commas(c) for c in cols])
