"""Best canonical name per name, against a canonical table of any size.

The score of two token-sorted names is 200 * LCS / (len + len). LCS is at most
the number of characters they share, counted with multiplicity, so a score of
``cutoff`` needs an overlap of ``cutoff / 200 * (len + len)`` between the sets
of (character, occurrence) pairs. That is a set overlap join, and its candidates
come from an inverted index with a prefix filter:

* the pairs of all names stand in one order, rarest first;
* two sets with overlap ``o`` share ``m`` elements within the first
  ``len - o + m`` of each, so a name is filed under every combination of ``m``
  of these (``m`` up to 3, less for long names: a combination is far rarer than
  a character);
* names with a combination in common are candidates, unless their lengths or
  128-bit signatures of their sets show that the overlap is too small;
* two names that share ``k`` elements share many combinations of them. The rarest
  ``m`` are one that both are filed under, so a pair leaves the join under that one:
  elsewhere both signatures show an earlier element. Only the ``EXACT`` most frequent
  elements have a bit of their own and can show it, so a pair may come more than once
  (which changes no minimum), and never not at all.

Only candidates are scored (bit-parallel LCS over whole Arrow batches). Nothing
with a score of ``cutoff`` or more is missed, so the best match is that of
comparing all with all; ties go to the smallest priority, then the smaller name.

Names equal to a canonical name after token sorting score 100 and leave first.
The rest goes through descending cutoffs: a high one makes short prefixes and
few candidates, and a name that finds a match there can't find a better one
below. A combination held by more than ``BLOCK`` canonical names is cut into
blocks of about that many, each met by its own copy of the names, so no
combination is joined in one task.

Null names and names without characters match nothing. Names are matched once
per distinct value; the canonical table may hold repeated names (the smallest
priority counts).
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.functions import dictionaries as D
from laborlens.functions.similarity import token_sort
from laborlens.session import materialise

#: canonical names of one combination that meet in one task
BLOCK = 2_000
#: (elements in a combination, names up to this length): long names have many combinations
COMBINE = ((3, 24), (2, 120), (1, math.inf))
#: (character, occurrence) pairs whose frequency is counted to order the rest; any order is right
ORDERED = 4_096
#: the most frequent of them, with a bit of their own among the 128 of a signature
EXACT = 96
LISTED = 1 << 60  # above every number of an unlisted element
PAIRS_PER_STEP = 8_192
ROWS_PER_STEP = 1 << 17


def least_overlap(length: int, cutoff: float) -> int:
    """Characters that a name of this length shares with any name that scores ``cutoff``."""
    t = cutoff / 100
    shortest = math.ceil(length * t / (2 - t) - 1e-9)
    return max(1, math.ceil(t / 2 * (length + shortest) - 1e-9))


def combination_size(length: int, cutoff: float) -> int:
    return min(next(m for m, longest in COMBINE if length <= longest), least_overlap(length, cutoff))


def sizes_met(length: int, cutoff: float) -> set[int]:
    """The combination sizes under which a name of this length meets all lengths that can score ``cutoff``."""
    t, own = cutoff / 100, combination_size(length, cutoff)
    lo, hi = math.ceil(length * t / (2 - t) - 1e-9), math.floor(length * (2 - t) / t + 1e-9)
    return {min(own, combination_size(n, cutoff)) for n in range(max(1, lo), hi + 1)}


def element_keys(names: list[str], listed: np.ndarray) -> np.ndarray:
    """The (character, occurrence) pairs of names of one length as numbers, one row a name,
    rarest first. ``listed`` holds the ranked pairs, the most frequent last: their number is
    LISTED and their place; the others come before them in any fixed order."""
    size = len(names[0])
    codes = np.sort(np.array(names, dtype=f"<U{size}").view(np.uint32).reshape(len(names), size), axis=1).astype(np.int64)
    place = np.arange(size)
    starts = np.ones(codes.shape, bool)
    starts[:, 1:] = codes[:, 1:] != codes[:, :-1]
    keys = codes << 24 | (place - np.maximum.accumulate(np.where(starts, place, 0), axis=1))
    if len(listed):
        by_code = np.argsort(listed)
        at = by_code[np.minimum(np.searchsorted(listed, keys, sorter=by_code), len(listed) - 1)]
        keys = np.where(listed[at] == keys, LISTED + at, keys)
    return np.sort(keys, axis=1)


def element_bits(keys: np.ndarray, listed: int) -> np.ndarray:
    """The bit of each element in a signature: one of its own for the EXACT most frequent
    elements (the most frequent is bit 0), a shared one for the rest."""
    nth = LISTED + listed - 1 - keys
    shared = EXACT + (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(128 - EXACT)
    return np.where((keys >= LISTED) & (nth < EXACT), nth, shared.astype(np.int64))


def halves(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of rows of bits, as two signed longs (high, low)."""
    one = np.uint64(1) << (bits % 64).astype(np.uint64)
    return tuple(np.bitwise_or.reduce(np.where(bits // 64 == half, one, np.uint64(0)), axis=-1).view(np.int64) for half in (1, 0))


def earlier_bits(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For combinations (last axis: the bits of their elements, rarest first) the own bits of the
    elements that come before their last one and are not in them, as two signed longs."""
    nth = np.arange(EXACT)
    # the elements with own bits that are rarer than the one with bit b
    rarer = np.zeros((129, EXACT), np.int64)
    for b in range(EXACT):
        rarer[b] = np.where(nth > b, nth, 128)
    high, low = halves(np.where(rarer[:128] == 128, 128, rarer[:128]))
    return tuple(m[bits[..., -1]] & ~h for m, h in zip((np.where(np.arange(128) < EXACT, x, 0) for x in (high, low)), halves(bits), strict=True))


def combinations(keys: np.ndarray, cutoff: float) -> Iterator[np.ndarray]:
    """The places of the elements in each combination under which names of this length are filed."""
    n = keys.shape[1]
    spare = n - least_overlap(n, cutoff)
    for m in sorted(sizes_met(n, cutoff)):
        # two lengths that meet under m agree on it, so its prefix is long enough on both sides
        yield np.array(list(itertools.combinations(range(spare + m), m)), np.int64)


def hashed(elements: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each combination (last axis)."""
    h = np.full(elements.shape[:-1], elements.shape[-1], np.uint64)
    for i in range(elements.shape[-1]):
        h = (h ^ elements[..., i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def lcs_of_pairs(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """LCS length of each pair, bit-parallel over all pairs at once (words of 64 characters of ``right``)."""
    a, b = (np.array([x or "\0" for x in side], dtype=str) for side in (left, right))
    la, lb = (np.array([len(x) for x in side], np.int64) for side in (left, right))
    codes = [x.view(np.uint32).reshape(len(x), -1) for x in (a, b)]
    words = -(-codes[1].shape[1] // 64)
    target = codes[1]
    inside = np.arange(target.shape[1]) < lb[:, None]

    def pack(bits: np.ndarray) -> np.ndarray:
        out = np.zeros((len(bits), words * 8), np.uint8)
        some = np.packbits(bits, axis=1, bitorder="little")
        out[:, :some.shape[1]] = some
        return out.view("<u8")

    full = pack(inside)
    v = full.copy()
    for i in range(int(la.max(initial=0))):
        hit = pack((target == codes[0][:, i, None]) & inside & (i < la)[:, None])
        carry = np.zeros(len(a), np.uint64)
        for w in range(words):
            u = v[:, w] & hit[:, w]
            low = v[:, w] + u
            over = (low < u).astype(np.uint64)
            low += carry
            over |= (low < carry).astype(np.uint64)
            v[:, w], carry = (low | (v[:, w] - u)) & full[:, w], over  # v - u never borrows: u is a part of v
    return lb - np.bitwise_count(v).sum(axis=1).astype(np.int64)


def _ship_by_value() -> None:
    """Pickle this module's functions with the UDF, so workers need no package on their path."""
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _filer(cutoff: float, listed: np.ndarray, earlier: bool):
    """Index rows of (id, sorted): one per combination; with ``earlier`` also its ``earlier_bits``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for size, alike in rows.groupby(rows["sorted"].str.len()):
                if not size:
                    continue
                at, step = 0, 0
                while at < len(alike):
                    some = alike.iloc[at:at + max(1, step)]
                    keys = element_keys(some["sorted"].tolist(), listed)
                    filed = list(combinations(keys, cutoff))
                    at, step = at + len(some), ROWS_PER_STEP // sum(map(len, filed))
                    bits = element_bits(keys, len(listed))
                    high, low = halves(bits)
                    for places in filed:
                        times = len(places)
                        out = {"id": np.repeat(some["id"].to_numpy(), times), "size": np.full(len(some) * times, size, np.int32),
                               "high": np.repeat(high, times), "low": np.repeat(low, times)}
                        if earlier:
                            out["earlier_high"], out["earlier_low"] = (x.ravel() for x in earlier_bits(bits[:, places]))
                        yield pd.DataFrame(out | {"combination": hashed(keys[:, places]).ravel()})
    return run


def _scorer():
    @F.pandas_udf("double")
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.empty(len(left))
        total = left.str.len().to_numpy() + right.str.len().to_numpy()
        order = np.argsort(total, kind="stable")  # alike widths together
        a, b = left.to_numpy(), right.to_numpy()
        for at in range(0, len(order), PAIRS_PER_STEP):
            rows = order[at:at + PAIRS_PER_STEP]
            out[rows] = 200.0 * lcs_of_pairs(a[rows].tolist(), b[rows].tolist()) / total[rows]
        return pd.Series(out, index=left.index)
    return score


def element_ranks(names: DataFrame) -> dict[int, int]:
    """The ORDERED most frequent (character, occurrence) pairs, the most frequent ranked last."""
    chars = names.select(F.posexplode(F.array_sort(F.split("sorted", ""))).alias("at", "c"), "sorted")
    # within the sorted characters, a character's occurrence is its place after the first one
    occurrence = F.col("at") + 1 - F.array_position(F.array_sort(F.split("sorted", "")), F.col("c"))
    top = (chars.where("c <> ''").select("c", occurrence.alias("n")).groupBy("c", "n").count()
           .orderBy(F.desc("count"), "c", "n").limit(ORDERED).collect())  # at most ORDERED rows
    return {ord(r.c) << 24 | int(r.n): len(top) - i for i, r in enumerate(top) if len(r.c) == 1}


def candidates(names: DataFrame, canon: DataFrame, cutoff: float, rank: dict[int, int]) -> DataFrame:
    """(id, canon_id): the pairs of (id, sorted) rows that share a combination and whose lengths
    and signatures can score ``cutoff``; a pair comes again only if it shares rarer elements
    than the EXACT ones."""
    _ship_by_value()
    listed = np.array(sorted(rank, key=rank.get), np.int64)
    shape = "id long, size int, high long, low long, combination long"
    # a name far longer than every canonical one has many combinations and no partner
    longest = canon.agg(F.coalesce(F.max(F.length("sorted")), F.lit(0))).first()[0] * (200 / cutoff - 1)
    left = names.where(F.length("sorted") <= longest).select("id", "sorted").mapInPandas(
        _filer(cutoff, listed, True), shape.replace("combination", "earlier_high long, earlier_low long, combination"))
    right = canon.select("id", "sorted").mapInPandas(_filer(cutoff, listed, False), shape)
    right = right.select(F.col("id").alias("canon_id"), *[F.col(c).alias(f"canon_{c}") for c in ("size", "high", "low")], "combination")
    # the few combinations of very many canonical names: their number of blocks
    common = right.groupBy("combination").count().where(F.col("count") > BLOCK).select(
        "combination", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    common = materialise(common, "similarity-common")
    blocks = F.coalesce("blocks", F.lit(1))
    left = left.join(common, "combination", "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("blocks")
    right = right.join(common, "combination", "left").withColumn("block", F.pmod(F.xxhash64("canon_id"), blocks).cast("int")).drop("blocks")

    def kept(a: str, b: str) -> Column:
        """At most so many characters of ``a`` are in ``b``: a bit that only ``a`` has stands for one or more that are not."""
        return F.col(f"{a}size") - sum((F.bit_count(F.col(a + h).bitwiseAND(F.bitwise_not(F.col(b + h)))) for h in ("high", "low")), F.lit(0))

    # both have a rarer element that is not in this combination: they meet under another one too
    first = sum((F.bit_count(F.col(h).bitwiseAND(F.col(f"canon_{h}")).bitwiseAND(F.col(f"earlier_{h}"))) for h in ("high", "low")), F.lit(0)) == 0
    reach = 200 * F.least(kept("", "canon_"), kept("canon_", "")) >= cutoff * (F.col("size") + F.col("canon_size"))
    return left.join(right, ["combination", "block"]).where(first & reach).select("id", "canon_id")


class BestMatch:
    """Matches of ``names`` (one column ``name``) against ``canon`` (``name``, ``priority``).

    ``matches``: name, match, score of every distinct name that has one.
    ``candidates``: pairs that were scored, known once the matches were written."""

    def __init__(self, names: DataFrame, canon: DataFrame, cutoff: float = D.COMPANY_MATCH_CUTOFF,
                 tiers: Sequence[float] = (92.0, 85.0, 78.0)):
        if not 0 < cutoff <= 100:
            raise ValueError("cutoff must be above 0 and at most 100")
        one = F.monotonically_increasing_id().alias("id")  # given once, in what is written
        named = materialise(names.select("name").distinct().select("name", token_sort(F.col("name")).alias("sorted"))
                            .where("sorted <> ''"), "similarity-names")
        table = materialise(canon.select("name", "priority", token_sort(F.col("name")).alias("sorted")).where("sorted <> ''")
                            .groupBy("sorted").agg(F.min(F.struct("priority", "name")).alias("best"))
                            .select(one, "sorted", F.col("best.priority").alias("priority"), F.col("best.name").alias("match")),
                            "similarity-canon")
        self.candidates = 0
        keys = named.select("sorted").distinct()
        equal = keys.join(table.select("sorted", "match"), "sorted").withColumn("score", F.lit(100.0))
        todo = materialise(keys.join(table.select("sorted"), "sorted", "left_anti").select(one, "sorted"), "similarity-todo")
        found = [equal]
        rank = element_ranks(table)
        for tier in [*(t for t in sorted(tiers, reverse=True) if t > cutoff), float(cutoff)]:
            best = self._tier(todo, table, tier, rank)
            found.append(best.select("sorted", "match", "score"))
            todo = materialise(todo.join(best.select("id"), "id", "left_anti"), "similarity-todo")
        both = reduce(DataFrame.unionByName, found)
        self.matches = named.join(both, "sorted").select("name", "match", "score")

    def _tier(self, todo: DataFrame, table: DataFrame, cutoff: float, rank: dict[int, int]) -> DataFrame:
        canon = table.select(F.col("id").alias("canon_id"), F.col("sorted").alias("canon_sorted"), "priority", "match")
        pairs = candidates(todo, table, cutoff, rank).join(todo, "id").join(canon, "canon_id")
        scored = pairs.withColumn("score", _scorer()("sorted", "canon_sorted"))
        reached = F.when(F.col("score") >= cutoff, F.struct((-F.col("score")).alias("worse"), "priority", "match"))
        best = materialise(scored.groupBy("id", "sorted").agg(F.min(reached).alias("best"), F.count(F.lit(1)).alias("pairs")),
                           "similarity-best")
        self.candidates += best.agg(F.sum("pairs")).first()[0] or 0
        return best.where("best is not null").select("id", "sorted", "best.match", (-F.col("best.worse")).alias("score"))


def best_matches(names: DataFrame, canon: DataFrame, cutoff: float = D.COMPANY_MATCH_CUTOFF) -> DataFrame:
    """name, match, score of every distinct ``name`` whose best canonical name scores ``cutoff`` or more."""
    return BestMatch(names, canon, cutoff).matches
