"""Periodic runs of words inside documents, by seeds and extension along diagonals.

A run is a maximal stretch of words with smallest period q, at least
``min_length`` words and ``times`` periods long. In such a run the words agree
at lag q over at least ``max(min_length - q, (times - 1) * q)`` places: the
guaranteed overlap. Lags are dealt into classes; for a class [lo, hi] the index
holds the k-grams of the overlap that every lag of the class guarantees, so a
run shows as two equal k-grams q words apart.

Pairs are not all pairs of equal k-grams. If a k-gram occurs again after d < q
words inside a run of smallest period q, it has both periods, and they would
have a common shorter one unless d > k - q + 1. Occurrences nearer than the
period are therefore at least ``k - hi + 2`` words apart, and the pair at lag q
is among each occurrence's next ``hi // (k - hi + 2)`` ones; classes are cut so
that this is at most ``PARTNERS``. Nothing is missed, and a word repeated n
times makes a few pairs a place, not n.

A pair is extended to both sides while the words agree. A table with the
furthest place covered per lag keeps pairs of a stretch that was extended
before from being extended again. Stretches long enough, whose period has no
shorter one dividing it, are the runs.

k-grams are ranks of prefix doubling, so equal ranks are equal words. Most
documents have no k-gram of the shortest kind twice; one hash pass over a whole
block of documents finds those that do (equal k-grams have equal hashes), and
only those are ranked.

Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte. Null, empty and blank
texts have no words and no runs. Every row is handled by itself: null or
repeated ids and repeated rows each give a row of their own; other columns
travel in the struct ``row``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.llm.byte_bpe import steps
from laborlens.llm.common import ASCII_SPACE, prepare, text_or_empty

#: following occurrences that each k-gram is paired with, at most
PARTNERS = 2
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def overlap(lag: int, min_length: int, times: int) -> int:
    return max(min_length - lag, (times - 1) * lag)


def lag_classes(longest: int, min_length: int, times: int) -> Iterator[tuple[int, int, int, int]]:
    """(lo, hi, k, partners) of classes that cover the lags 1 to ``longest``."""
    lo = 1
    while lo <= longest:
        hi, k, partners = lo, overlap(lo, min_length, times), 1
        for q in range(lo + 1, longest + 1):
            wider = min(k, overlap(q, min_length, times))
            apart = wider - q + 2
            if wider < q or apart < 1 or q // apart > PARTNERS:
                break
            hi, k, partners = q, wider, max(1, q // apart)
        yield lo, hi, k, partners
        lo = hi + 1


class Grams:
    """Ranks of the k-grams of one document, by prefix doubling."""

    def __init__(self, ids: np.ndarray):
        self.ranks = [ids]

    def of(self, k: int) -> np.ndarray:
        level = k.bit_length() - 1
        while len(self.ranks) <= level:
            r, half = self.ranks[-1], 1 << (len(self.ranks) - 1)
            self.ranks.append(np.unique(r[:-half] * (int(r.max()) + 1) + r[half:], return_inverse=True)[1])
        r, rest = self.ranks[level], k - (1 << level)
        return r if not rest else r[:-rest] * (int(r.max()) + 1) + r[rest:]


def agree(ids: np.ndarray, i: int, lag: int) -> tuple[int, int]:
    """The stretch of places [a, b) around i at which the words agree with those ``lag`` further on."""
    n, width, b = len(ids) - lag, 64, i
    while b < n:
        to = min(n, b + width)
        off = np.flatnonzero(ids[b:to] != ids[b + lag:to + lag])
        if len(off):
            b += int(off[0])
            break
        b, width = to, width * 2
    a, width = i, 64
    while a > 0:
        to = max(0, a - width)
        off = np.flatnonzero(ids[to:a] != ids[to + lag:a + lag])
        if len(off):
            a = to + int(off[-1]) + 1
            break
        a, width = to, width * 2
    return a, b


def prime_divisors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return out + [n] * (n > 1)


def runs_of(ids: np.ndarray, min_length: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in a sequence of word numbers, by start, then period."""
    n = len(ids)
    if n < min_length:
        return []
    grams, runs, covered = Grams(np.unique(ids, return_inverse=True)[1].astype(np.int64)), [], {}
    for lo, hi, k, partners in lag_classes(n // times, min_length, times):
        if k > n - lo:
            break
        keys = grams.of(k)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        if not (ranked[1:] == ranked[:-1]).any():
            break  # longer ones are not repeated either
        at, lags = [], []
        for t in range(1, partners + 1):
            same = ranked[t:] == ranked[:-t]
            here = order[:-t][same]
            lag = order[t:][same] - here
            fits = (lag >= lo) & (lag <= hi)
            at.append(here[fits])
            lags.append(lag[fits])
        at, lags = np.concatenate(at), np.concatenate(lags)
        sort = np.lexsort((at, lags))
        at, lags = at[sort], lags[sort]
        new = np.ones(len(at), bool)  # seeds next to each other lie in one stretch
        new[1:] = (lags[1:] != lags[:-1]) | (at[1:] - at[:-1] > 1)
        for i, lag in zip(at[new].tolist(), lags[new].tolist(), strict=True):
            if i < covered.get(lag, 0):
                continue
            a, b = agree(ids, i, lag)
            covered[lag] = b
            length = b - a + lag
            if length < max(min_length, times * lag):
                continue
            if any(np.array_equal(ids[a:a + lag], ids[a + lag // p:a + lag // p + lag]) for p in prime_divisors(lag)):
                continue
            runs.append((a, length, lag))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def repeating(words: list[list[bytes]], k: int) -> set[int]:
    """Numbers of the documents that may hold a k-gram twice: all that do, and few others."""
    sizes = np.array([len(w) for w in words], np.int64)
    if not sizes.sum():
        return set()
    h = np.fromiter((hash(x) for w in words for x in w), np.int64, int(sizes.sum())).view(np.uint64)
    doc = np.repeat(np.arange(len(words)), sizes)
    done = 1
    with np.errstate(over="ignore"):
        while done < k:  # windows of ``done`` words become windows of ``done + step``
            step = min(done, k - done)
            if len(h) <= step:
                return set()
            tail = h[step:]
            h = (h[:-step] * np.uint64(0x9E3779B97F4A7C15)) ^ (tail + (tail >> np.uint64(29)))
            done += step
        whole = doc[:len(h)] == doc[k - 1:k - 1 + len(h)]
        doc = doc[:len(h)][whole]
        h = h[whole] ^ (doc.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(h)
    twice = np.flatnonzero(h[order][1:] == h[order][:-1])
    return set(doc[order[twice]].tolist()) | set(doc[order[twice + 1]].tolist())


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words left when every run keeps its first period only."""
    if not runs:
        return words
    stay = np.ones(len(words), bool)
    for start, length, period in runs:
        stay[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(stay).tolist()]


def _finder(min_length: int, times: int):
    shortest = min(overlap(q, min_length, times) for q in range(1, min_length + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode("utf-8") for t in batch.column("t").to_pylist()]
            for a, b in steps([len(t) for t in texts]):
                words = [t.split() for t in texts[a:b]]  # bytes are split at the six ASCII characters
                found = [[] for _ in words]
                for i in repeating(words, shortest):
                    number: dict[bytes, int] = {}
                    ids = np.array([number.setdefault(w, len(number)) for w in words[i]], np.int64)
                    found[i] = runs_of(ids, min_length, times)
                flat = np.array([r for rs in found for r in rs], np.int64).reshape(-1, 3)
                cut = pa.array(np.concatenate([[0], np.cumsum([len(rs) for rs in found])]), pa.int32())
                structs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)],
                                                     names=["start", "length", "period"])
                left = [b" ".join(collapse(w, rs)).decode("utf-8") for w, rs in zip(words, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(a, b - a), pa.array([len(w) for w in words], pa.int64()),
                     pa.ListArray.from_arrays(cut, structs), pa.array(left, pa.string())],
                    names=["row", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, text_col: str = "text", min_length: int = 24, times: int = 3,
                  keep_cols: list[str] | None = None) -> DataFrame:
    """row (struct of ``keep_cols``, by default all columns but the text), n_words, runs
    (start, length and period in words, by start, then period), collapsed (the words
    outside repeated periods joined by one space). ``times`` is 3 or more: below that,
    no small number of partners finds every run."""
    if times < 3 or min_length < times:
        raise ValueError("times must be at least 3, min_length at least times")
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != text_col] if keep_cols is None else keep_cols
    row = F.struct(*[F.col(c) for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    rows = docs.select(row.alias("row"), F.col(text_col).cast("string").alias("t"))
    shape = rows.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUNS).alias("runs"),
                        F.lit("").alias("collapsed")).schema
    return rows.mapInArrow(_finder(min_length, times), shape)


def words_of(text: Column) -> Column:
    """The words of a text as an array."""
    blank = F.translate(text_or_empty(text), ASCII_SPACE, " " * len(ASCII_SPACE))
    return F.filter(F.split(blank, " "), lambda w: w != "")


def strongest(runs: Column) -> Column:
    """The run with the greatest length/period, compared exactly (ties: smallest start, then period)."""
    none = F.lit(None).cast(RUNS[len("array<"):-1])
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
