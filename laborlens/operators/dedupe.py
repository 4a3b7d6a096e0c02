"""Deterministic keep-one dedupe.

Keep-first is written as an aggregation, ``min(struct(order..., payload...))``
per key, not as a ``row_number`` window: the aggregate runs partially on the
map side, so a key holding a third of all rows collapses to one row per map
task before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
               last: bool = False) -> DataFrame:
    """One row per ``keys``: the one with the smallest (``last``: largest)
    ``order`` tuple; nulls sort first. Remaining columns break exact ties, so
    the result never depends on input order. Column order is preserved.

    Order items that are plain column names lead the packed struct under their
    own names (not copied), so the sorted rows carry each column once.

    A minimum of a struct is aggregated by sorting. The keys are grouped behind
    their hash: keys of one form (names, URLs) begin alike, and the sort would
    compare them whole, where it now compares one number."""
    keys = list(keys)
    lead, lead_names = [], []
    for i, o in enumerate(order):
        if isinstance(o, str) and o in df.columns and o not in keys and o not in lead_names:
            lead.append(F.col(o).alias(o))
            lead_names.append(o)
        else:
            lead.append((F.col(o) if isinstance(o, str) else o).alias(f"_o{i}"))
    rest = [c for c in df.columns if c not in keys and c not in lead_names]
    packed = F.struct(*lead, *[F.col(c).alias(c) for c in rest])
    agg = F.max(packed) if last else F.min(packed)
    out = df.groupBy(F.xxhash64(*[F.col(k) for k in keys]).alias("_hash"), *keys).agg(agg.alias("_kept"))
    return out.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


ROOT_URL_RE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/?$"


def news_url_key(url: Column | str, title: Column | str, company: Column | str) -> Column:
    """U2 key: the URL; a bare site root (one page for many items, e.g. a
    tracker) is not an identity, so it is qualified by the title; an empty
    URL falls back to title|company (U4)."""
    u = F.col(url) if isinstance(url, str) else url
    t = F.col(title) if isinstance(title, str) else title
    return F.when(u.rlike(ROOT_URL_RE), F.concat_ws("|", u, F.coalesce(t, F.lit("")))) \
        .otherwise(fallback_key(u, title, company))


def fallback_key(url: Column | str, *parts: Column | str) -> Column:
    """U4: the URL when non-empty, else the other fields joined by ``|``."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.nullif(url, F.lit("")),
                      F.concat_ws("|", *[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts]))
