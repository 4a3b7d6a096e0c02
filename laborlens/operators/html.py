"""HTML extraction as column expressions (A6-A9): regex over landed pages.

Tables, list links and JSON-LD blocks are machine-generated and regular, so
``regexp_extract_all`` + ``transform``/``posexplode`` recover them per row,
inside the JVM, whatever the case of tags, their attributes and quotes; a table
inside a table's cell ends the outer one and is not read as its own. The boards'
nested job cards go through ``cards.board_cards``.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.functions.dates import relative_date
from laborlens.functions.text import title_case
from laborlens.operators.cards import board_cards

TABLE_RE = r"(?is)<table\b[^>]*>(.*?)</table\s*>"
ROW_RE = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
CELL_RE = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"
LD_JSON_RE = r"""(?is)<script\b[^>]*\btype\s*=\s*["']?application/ld\+json\b[^>]*>(.*?)</script\s*>"""
LINK_RE = r'<li><a href="([^"]*)">([^<]*)</a></li>'
ENTITY_RE = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
BLANK = "[\\s\\u00a0]"


def unescape(c: Column) -> Column:
    """Character references decoded: numeric ones, and the named ones of HTML 4
    (the standard library's table); others stay as they are."""
    named = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))])

    def point(ref: Column) -> Column:
        digits = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10)).otherwise(F.substring(ref, 2, 7))
        n = digits.try_cast("int")
        valid = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))

    def put(text: Column, ref: Column) -> Column:
        char = F.when(ref.startswith("#"), point(ref)).otherwise(F.try_element_at(named, ref))
        whole = F.concat(F.lit("&"), ref, F.lit(";"))
        return F.replace(text, whole, F.coalesce(char, whole))

    # "&" itself comes last, so that what it leaves is not read as a reference again
    refs = F.array_distinct(F.regexp_extract_all(c, F.lit(ENTITY_RE), 1))
    amp = F.array(*[F.lit(x) for x in ("amp", "#38", "#x26", "#X26")])
    first, last = F.array_except(refs, amp), F.array_intersect(refs, amp)
    marked = F.aggregate(last, F.aggregate(first, c, put), lambda t, ref: F.replace(t, F.concat(F.lit("&"), ref, F.lit(";")), F.lit("&")))
    return F.when(c.contains("&"), marked).otherwise(c)


def cell_text(c: Column) -> Column:
    """Text of a cell: its pieces between tags, each without white space around it, joined; entities decoded."""
    blanks = F.regexp_replace(c, r"&nbsp;|&#160;|&#[xX][aA]0;", "\u00a0")
    joined = F.regexp_replace(blanks, f"{BLANK}*<[^>]+>{BLANK}*", "")
    return unescape(F.regexp_replace(joined, f"^{BLANK}+|{BLANK}+$", ""))


def row_cells(markup: Column) -> Column:
    """Cells of every ``<tr>`` as array<array<string>>; rows without cells dropped."""
    rows = F.regexp_extract_all(markup, F.lit(ROW_RE), 1)
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(CELL_RE), 1), cell_text))
    return F.filter(cells, lambda c: F.size(c) > 0)


def table_rows(df: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """Every non-empty row of every table as (row_idx, cells array)."""
    return df.select(*keep, F.posexplode(row_cells(F.col(html))).alias("row_idx", "cells"))


def header_records(df: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """A8 + Y9: per table the first non-empty row is the header (lower-cased,
    spaces -> "_"); its later rows with as many cells become ``map(header -> cell)``.
    Tables are taken apart inside the row, so page content is never shuffled.
    A header that repeats a name keeps the last cell of that name."""
    tables = F.regexp_extract_all(F.col(html), F.lit(TABLE_RE), 1)
    out = df.select(*keep, F.posexplode(tables).alias("table_idx", "_table"))
    out = out.select(*keep, "table_idx", row_cells(F.col("_table")).alias("_rows"))
    header = F.transform(F.get("_rows", F.lit(0)), lambda c: F.regexp_replace(F.lower(c), " ", "_"))
    out = out.select(*keep, "table_idx", header.alias("_header"), F.posexplode("_rows").alias("row_idx", "_cells"))
    out = out.where((F.col("row_idx") > 0) & (F.size("_cells") == F.size("_header")))
    last = F.filter(F.arrays_zip(F.col("_header").alias("k"), F.col("_cells").alias("v")), lambda e, i: ~F.array_contains(
        F.slice(F.col("_header"), i + 2, F.size("_header")), e.getField("k")))
    return out.select(*keep, "table_idx", "row_idx", F.map_from_entries(last).alias("rec"))


def ld_json_blocks(html: Column) -> Column:
    """The bodies of all JSON-LD script blocks."""
    return F.regexp_extract_all(html, F.lit(LD_JSON_RE), 1)


def link_cards(html: Column) -> Column:
    """List-item links as array<struct<href, text>>."""
    hrefs = F.regexp_extract_all(html, F.lit(LINK_RE), 1)
    texts = F.regexp_extract_all(html, F.lit(LINK_RE), 2)
    return F.arrays_zip(hrefs.alias("href"), texts.alias("text"))


LD_POSTING_SCHEMA = ("struct<`@type`:string,title:string,hiringOrganization:struct<name:string>,datePosted:string,"
                     "url:string,baseSalary:struct<value:struct<value:string>>>")


def _posting(title: Column, company: Column, location: Column, experience: Column, salary: Column,
             posted_date: Column, job_url: Column) -> Column:
    return F.struct(title.alias("title"), company.alias("company"), location.alias("location"),
                    experience.alias("experience"), salary.alias("salary"), posted_date.alias("posted_date"),
                    job_url.alias("job_url"))


def _located(location: Column, city: Column | None) -> Column:
    """The posting's own location, or the title-cased city of its page where it has none."""
    return location if city is None else F.coalesce(F.nullif(location, F.lit("")), title_case(city))


def ld_postings(html: Column, city: Column | None = None) -> Column:
    """JobPosting items of all JSON-LD blocks (a block is one object or a list)
    as array<struct<title, company, location, experience, salary, posted_date, job_url>>;
    the location is the page's city (null without one)."""
    def items(body):
        return F.when(body.rlike(r"^\s*\["), F.from_json(body, f"array<{LD_POSTING_SCHEMA}>")) \
            .otherwise(F.array(F.from_json(body, LD_POSTING_SCHEMA)))
    all_items = F.flatten(F.transform(ld_json_blocks(html), items))
    postings = F.filter(all_items, lambda it: it.getField("@type") == "JobPosting")
    none = F.lit(None).cast("string")
    return F.transform(postings, lambda it: _posting(
        it.getField("title"), it.getField("hiringOrganization").getField("name"), _located(none, city), F.lit(""),
        it.getField("baseSalary").getField("value").getField("value"), it.getField("datePosted"), it.getField("url")))


def card_postings(html: Column, company: Column, city: Column | None = None, as_of: Column | None = None) -> Column:
    """The cards of a page as the same struct shape: each board card's own
    fields, its relative date counted from ``as_of`` (kept as text without one);
    on a page without board cards its list-item links, company from the page."""
    def card(c):
        date = c.getField("posted_date")
        return _posting(c.getField("title"), c.getField("company"), _located(c.getField("location"), city),
                        c.getField("experience"), c.getField("salary"),
                        date if as_of is None else relative_date(date, as_of), c.getField("job_url"))

    def link(c):
        none = F.lit(None).cast("string")
        return _posting(c.getField("text"), company, _located(none, city), none, none, none, c.getField("href"))

    cards = board_cards(html)
    return F.when(F.size(cards) > 0, F.transform(cards, card)).otherwise(F.transform(link_cards(html), link))


def page_postings(html: Column, company: Column, mode: str = "fallback", city: Column | None = None,
                  as_of: Column | None = None) -> Column:
    """A6 + A7 per page: ``fallback`` takes the cards, or the JSON-LD postings
    only when the page has no cards; ``both`` takes cards and JSON-LD postings."""
    cards, ld = card_postings(html, company, city, as_of), ld_postings(html, city)
    if mode == "both":
        return F.concat(cards, ld)
    return F.when(F.size(cards) > 0, cards).otherwise(ld)
