"""Quality classifier: random Fourier features over document statistics.

1. Every whole text becomes a vector of statistics (lengths, character
   classes, repetition of words and lines, compressibility).
2. Standardised statistics pass through random Fourier features, which
   approximate a Gaussian kernel.
3. Each partition of labelled rows sums its normal equations (X'X, X'y); the
   sums are added up and one ridge system is solved.
4. Isotonic calibration (pool adjacent violators over binned scores of a fold
   that the ridge did not see) turns ridge scores into values from 0 to 1.

All labelled training rows take part; ids, labels, languages and sources never
enter a score. Null texts are empty texts and get a score like any other; rows
with null ids are scored and never trained on; labels that are neither 0 nor 1
are ignored; without any label (or with one class only) every score is the
share of label 1 among the labels, 0.5 if there are none. Repeated rows are
scored alike. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborlens.llm.common import keep, prepare

STATS = ("log_bytes log_words log_lines word_len word_len_sd upper lower digit punct bang space non_ascii entropy "
         "distinct_words same_next distinct_pairs distinct_lines line_words sentence_ends compressed").split()
FEATURES = 384
GAMMA = 0.06
RIDGE = 1e-3
SCORE_BINS = 1024
SEED = 20240229
ROWS_PER_STEP = 512

_CLASS = np.zeros((256, 7))
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = [_b < 128 and _c.isupper(), _b < 128 and _c.islower(), _b < 128 and _c.isdigit(),
                  33 <= _b < 127 and not _c.isalnum(), _c in "!?", _c in " \t\n\x0b\x0c\r", _b >= 128]


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text, all finite, zeros for an empty one."""
    raw = (text or "").encode("utf-8")
    out = np.zeros(len(STATS))
    n = len(raw)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = counts[counts > 0] / n
    words = raw.split()
    lines = raw.split(b"\n")
    m = len(words)
    out[0], out[1], out[2] = np.log1p(n), np.log1p(m), np.log1p(len(lines))
    out[5:12] = counts @ _CLASS / n
    out[12] = -(share * np.log2(share)).sum()
    if m:
        lens = np.fromiter(map(len, words), dtype=np.float64, count=m)
        out[3], out[4] = min(lens.mean(), 40.0), min(lens.std(), 40.0)
        root = np.sqrt(m)  # distinct words grow about as a power of the length: compare beyond it
        out[13] = len(set(words)) / m * min(1.0, root / 30.0) + max(0.0, 1.0 - root / 30.0)
        out[14] = sum(map(eq, words, words[1:])) / m
        out[15] = len(set(zip(words, words[1:]))) / max(1, m - 1)
        out[17] = np.log1p(m / len(lines))
    out[16] = len(set(lines)) / len(lines)
    out[18] = min(1.0, (counts[46] + counts[33] + counts[63]) / max(1, m))
    out[19] = min(2.0, len(zlib.compress(raw, 1)) / n)
    return out


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_STEP):
            rows = batch.slice(at, ROWS_PER_STEP)
            x = np.array([statistics(t) for t in rows.column(1).to_pylist()]).reshape(rows.num_rows, len(STATS))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(STATS)).cast(pa.list_(pa.float64()))],
                names=["row", "stats"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATS))


@dataclass
class Model:
    """A fitted classifier: small arrays only."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None  # of the Fourier features and the constant
    knots: np.ndarray  # ridge scores, ascending
    values: np.ndarray  # their calibrated values, ascending
    constant: float

    def features(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.normal(0.0, np.sqrt(2 * GAMMA), (len(STATS), FEATURES))
        phase = rng.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.hstack([np.cos(z @ w + phase) * np.sqrt(2 / FEATURES), z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.constant)
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the closest non-decreasing values."""
    blocks: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(k), v) for v, _, k in blocks]) if blocks else np.empty(0)


def _normal_equations(model: Model):
    d = FEATURES + len(STATS) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, n = np.zeros((d, d)), np.zeros(d), 0
        for batch in batches:
            if batch.num_rows:
                x = model.features(_matrix(batch.column("stats")))
                y = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
                a, b, n = a + x.T @ x, b + x.T @ y, n + len(y)
        if n:
            yield pa.RecordBatch.from_pydict({"a": [a.tobytes()], "b": [b.tobytes()], "n": [n]})
    return run


def fit(training: DataFrame) -> Model:
    """``training``: stats, label (0 or 1), fold (true: only calibrates). All rows are used."""
    moments = training.agg(
        F.count(F.lit(1)).alias("n"), F.avg("label").alias("share"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(len(STATS))],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(len(STATS))]).first()
    model = Model(np.zeros(len(STATS)), np.ones(len(STATS)), None, np.zeros(1), np.zeros(1),
                  0.5 if not moments.n else float(moments.share))
    if not moments.n or moments.share in (0.0, 1.0):
        return model
    model.mean = np.array([moments[f"m{i}"] for i in range(len(STATS))])
    model.scale = np.array([max(moments[f"s{i}"], 1e-3) for i in range(len(STATS))])
    d = FEATURES + len(STATS) + 1
    # one row of sums per partition (at most 16 partitions)
    sums = training.where(~F.col("fold")).coalesce(16).mapInArrow(
        _normal_equations(model), "a binary, b binary, n long").collect()
    if not sums:
        return model
    a = sum(np.frombuffer(s.a).reshape(d, d) for s in sums)
    b = sum(np.frombuffer(s.b) for s in sums)
    n = sum(s.n for s in sums)
    penalty = np.full(d, RIDGE * n)
    penalty[-1] = 1e-9 * n
    model.weights = np.linalg.solve(a + np.diag(penalty), b)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = np.rint(np.clip(model.raw(_matrix(batch.column("stats"))), -1, 2) * SCORE_BINS).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("label")], names=["at", "label"])

    # at most 3 * SCORE_BINS + 1 bins reach the driver
    bins = (training.where("fold").select("stats", "label").mapInArrow(binned, "at long, label int")
            .groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("share")).orderBy("at").collect())
    if bins:
        model.knots = np.array([r["at"] / SCORE_BINS for r in bins])
        model.values = isotonic(np.array([r["share"] for r in bins]), np.array([r["n"] for r in bins], dtype=float))
    else:
        model.knots, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def held_out(id_col: Column) -> Column:
    """Whether the row is kept from training: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row: struct of the id, stats) of every whole text."""
    prepare(docs.sparkSession)
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("id")).alias("row"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(_stats, "row struct<id: long>, stats array<double>")


def fit_on_labels(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """Fit on the labelled rows whose id is not held out; a fifth of ids among them only calibrates."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1))
    rows = stats.select(F.col("row.id").alias("id"), "stats").where(~held_out(F.col("id")))
    training = keep(rows.join(known, "id").select(
        "stats", "label", (F.crc32(F.col("id").cast("string").cast("binary")) % 5 == 1).alias("fold")), "quality-training")
    return fit(training)


def _score_stats(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], names=["row", "score"])
    return run


def _keep_good(model: Model, text_at: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                rows = batch.slice(at, ROWS_PER_STEP)
                x = np.array([statistics(t) for t in rows.column(text_at).to_pylist()]).reshape(rows.num_rows, len(STATS))
                yield rows.filter(pa.array(model.score(x) >= threshold))
    return run


def filter_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose score reaches the threshold, all columns as they are."""
    model = fit_on_labels(keep(document_statistics(docs, id_col, text_col), "quality-stats"), labels, id_col=id_col)
    return docs.mapInArrow(_keep_good(model, docs.columns.index(text_col), threshold), docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    stats = keep(document_statistics(docs, id_col, text_col), "quality-stats")
    model = fit_on_labels(stats, labels, id_col=id_col)
    scored = stats.mapInArrow(_score_stats(model), "row struct<id: long>, score double")
    return scored.select(F.col("row.id").alias("doc_id"), held_out(F.col("row.id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
