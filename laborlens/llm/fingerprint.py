"""Document fingerprints by locally consistent parsing.

A text's bytes are the symbols of level 0. On every level runs of one symbol
become one unit, units get small labels by deterministic coin tossing (the
place and value of the lowest bit in which a name differs from its left
neighbour's, three times over), and a phrase starts at every local maximum of
the labels. Labels depend on a few neighbours only, so equal substrings are
cut alike inside whatever surrounds them. A phrase's name is a hash of its
units' names; the names are the symbols of the next level, up to one name for
the whole text.

The fingerprint is that root name and a sketch: the ``SKETCH`` smallest hashes
of the distinct phrase names of levels ``LOW`` and up. Likeness is the share of
common hashes among the smallest of both sketches' union (1 for equal roots).

Null texts are empty; empty texts share one fingerprint and are like each other
only; texts too short for a phrase of level ``LOW`` are sketched by their root
name. In the edited-text query rows go in ascending id, null ids first, rows
with one id by text; a single row is its own next one. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm.common import partitions, prepare
from laborlens.llm.rolling import BYTE, U, mix, prefix, span

LOW = 2
SKETCH = 64
BYTES_PER_STEP = 1 << 20
EMPTY = "0" * 16 + ":"


def _toss(name: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 8 with no two neighbours alike, from names with no two neighbours alike."""
    left = np.empty_like(name)
    left[1:] = name[:-1]
    left[first] = ~name[first]  # a text's first unit differs from its absent neighbour in every bit
    x = name ^ left
    place = np.bitwise_count((x & (~x + U(1))) - U(1))
    label = ((place << 1) | ((name >> place.astype(np.uint64)) & U(1)).astype(np.uint8)).astype(np.uint8)
    for _ in range(2):
        left = np.empty_like(label)
        left[1:] = label[:-1]
        left[first] = ~label[first]
        x = label ^ left
        place = np.bitwise_count((x & (~x + np.uint8(1))) - np.uint8(1))
        label = (place << 1) | ((label >> place) & np.uint8(1))
    return label


def _level(name: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and text starts of the next level; ``start`` has each text's first index (no text is empty)."""
    n = len(name)
    first = np.zeros(n, dtype=bool)
    first[start] = True
    # runs of one symbol are one unit
    head = np.empty(n, dtype=bool)
    head[0] = True
    np.not_equal(name[1:], name[:-1], out=head[1:])
    head |= first
    if not head.all():
        at = np.flatnonzero(head)
        length = np.diff(np.append(at, n))
        unit = name[at]
        unit = np.where(length > 1, mix(unit + length.astype(np.uint64) * U(0xC2B2AE3D27D4EB4F)), unit)
        start = np.searchsorted(at, start)
        first = first[at]
    else:
        unit = name
    label = _toss(unit, start)
    m = len(unit)
    cut = np.zeros(m, dtype=bool)
    if m > 2:
        cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    cut[np.append(start[1:], m) - 1] = False  # a last unit alone would be a phrase that never shrinks
    cut |= first
    at = np.flatnonzero(cut)
    h = prefix(unit)
    return span(h, at, np.append(at[1:], m)), np.searchsorted(at, start)


def _sketch_values(names: np.ndarray) -> np.ndarray:
    return (mix(names + U(0x9E3779B97F4A7C15)) >> U(32)).astype(np.uint32)


def _parse(texts: list[bytes]) -> list[str]:
    out = [EMPTY] * len(texts)
    live = [i for i, t in enumerate(texts) if t]
    if not live:
        return out
    lens = np.array([len(texts[i]) for i in live])
    owner = np.array(live)
    name = BYTE[np.frombuffer(b"".join([texts[i] for i in live]), dtype=np.uint8)]
    start = np.cumsum(lens) - lens
    root: dict[int, int] = {}
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    level = 0
    while len(owner):
        name, start = _level(name, start)
        level += 1
        size = np.diff(np.append(start, len(name)))
        who = np.repeat(owner, size)
        if level >= LOW:
            parts.append((who, _sketch_values(name)))
        done = size == 1
        for o, v in zip(owner[done].tolist(), name[start[done]].tolist(), strict=True):
            root[o] = v
            if level < LOW:
                parts.append((np.array([o]), _sketch_values(np.array([v], dtype=np.uint64))))
        if done.any():
            stay = ~np.repeat(done, size)
            name, owner, size = name[stay], owner[~done], size[~done]
            start = np.cumsum(size) - size
    who = np.concatenate([p[0] for p in parts]).astype(np.uint64)
    both = np.unique((who << U(32)) | np.concatenate([p[1] for p in parts]).astype(np.uint64))
    who, value = (both >> U(32)).astype(np.int64), (both & U(0xFFFFFFFF)).astype(">u4")
    lo = np.searchsorted(who, live)
    hi = np.searchsorted(who, live, side="right")
    for o, a, b in zip(live, lo.tolist(), hi.tolist(), strict=True):
        out[o] = f"{root[o]:016x}:{value[a:min(b, a + SKETCH)].tobytes().hex()}"
    return out


def fingerprints(texts: list[str | None]) -> list[str]:
    """The fingerprint of each whole text."""
    raw = [(t or "").encode("utf-8") for t in texts]
    out, at, held = [], 0, 0
    for i, t in enumerate(raw):
        held += len(t)
        if held >= BYTES_PER_STEP or i == len(raw) - 1:
            out += _parse(raw[at:i + 1])
            at, held = i + 1, 0
    return out


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard likeness of two fingerprints, from 0 to 1."""
    (ra, sa), (rb, sb) = a.split(":"), b.split(":")
    if ra == rb:
        return 1.0
    x, y = ({s[i:i + 8] for i in range(0, len(s), 8)} for s in (sa, sb))
    if not x or not y:
        return 0.0
    # a sketch shorter than SKETCH is the whole set
    smallest = sorted(x | y)[:SKETCH]
    return sum(v in x and v in y for v in smallest) / len(smallest)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(batch.column(1).to_pylist()), pa.string())],
                                             names=["doc_id", "fingerprint"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        run, "doc_id long, fingerprint string")


EDITED = ("doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
NULL_KEY = -(1 << 63)


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one id range in order, then (extra) the first row of the next range."""
    held = None  # the row that still waits for its next one: (id, text, fingerprint)

    def emit(rows):
        texts = [t for _, t, _ in rows]
        ids = [i for i, _, _ in rows[:-1]]
        edited = [edit(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
        fp = [f for _, _, f in rows]
        efp = fingerprints(edited)
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array(edited, pa.string()),
            pa.array(fp[:-1], pa.string()), pa.array(efp, pa.string()),
            pa.array([likeness(a, b) for a, b in zip(fp[:-1], efp, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(fp[:-1], fp[1:], strict=True)], pa.float64())],
            names=["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    ended = False
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = []
            for i, t, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                if not ended:
                    rows.append((i, t or ""))
                    ended = bool(x)  # of several first rows with one id only the first by text counts
            rows = [(i, t, f) for (i, t), f in zip(rows, fingerprints([t for _, t in rows]), strict=True)]
            if held is not None:
                rows = [held, *rows]
            if len(rows) > 1:
                yield emit(rows)
            if rows:
                held = rows[-1]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint, its edited text and that one's fingerprint, and their likeness.

    Rows are dealt to id ranges once; the first row of each range also goes to
    the range before it (and the very first to the last), so no row's text
    travels more than that."""
    spark = docs.sparkSession
    prepare(spark)
    n = partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY)).alias("k"))
    cuts = rows.agg(F.percentile_approx("k", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    # number of cuts below the key: a search in a literal array of at most `n` cuts
    cut_array = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    part = F.size(F.filter(cut_array, lambda c: c < F.col("k")))
    firsts = sorted((r.p, r.k) for r in rows.select("k").withColumn("p", part).groupBy("p").agg(F.min("k").alias("k")).collect())
    before = [(k, firsts[i - 1][0]) for i, (_, k) in enumerate(firsts)]
    # one row per range
    copies = spark.createDataFrame(before, "k long, to int") if before else spark.createDataFrame([], "k long, to int")
    dealt = rows.withColumn("p", part).withColumn("extra", F.lit(0)).unionByName(
        rows.join(F.broadcast(copies), "k").select("d", "t", "k", F.col("to").alias("p"), F.lit(1).alias("extra")))
    return (dealt.repartitionById(n, F.col("p")).sortWithinPartitions("extra", "k", "t")
            .select("d", "t", "extra").mapInArrow(_walk, EDITED))
