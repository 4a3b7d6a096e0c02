"""Line dedup over levelled sorted runs of line hashes.

Documents are taken in batches of ascending id. A batch's distinct line
hashes are anti-joined with each earlier run, one after the other: all are
bucketed alike and sorted by hash on disk, so they are merged bucket by bucket
and neither side is shuffled. Hashes not seen before become the batch's own run
at level 0. When a level holds ``fanout`` runs they are
compacted into one run of the next level, so a batch meets few runs however
many came before. Because batches ascend, a hash in any run belongs to a
smaller document; within a batch the smallest document keeps its lines.

A line's key is the line without ASCII white space at both ends, A-Z lower
case. Keys under ``min_chars`` code points are never dropped. Null or empty
texts are one empty line. Rows with one id are one document (their lines are
not duplicates of each other, each row is rebuilt by itself); rows without an
id count as one document after all others. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm.common import ASCII_SPACE, keep, keep_bucketed, partitions, prepare, shared

SPACE = ASCII_SPACE.encode()
ROWS_PER_STEP = 512
#: keys with more than this share of all rows are joined by broadcast (at most 1/share of them)
HOT_SHARE = 1 / 2000


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """16-byte hash of the line's key, None if the key is too short."""
    import xxhash
    key = line.strip(SPACE).lower()  # bytes.lower changes A-Z only
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                rows = batch.slice(at, ROWS_PER_STEP)
                ids, hs = [], []
                for i, t in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                    own = {line_hash(x, min_chars) for x in (t or "").encode("utf-8").split(b"\n")}
                    own.discard(None)
                    ids += [i] * len(own)
                    hs += own
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hs, pa.binary())], names=["d", "h"])
    return run


def _rebuild(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                rows = batch.slice(at, ROWS_PER_STEP)
                n_lines, n_dropped, kept = [], [], []
                for t, gone in zip(rows.column("t").to_pylist(), rows.column("gone").to_pylist(), strict=True):
                    if not gone:
                        n_lines.append((t or "").count("\n") + 1)
                        n_dropped.append(0)
                        kept.append(t or "")
                        continue
                    gone = set(gone)
                    lines = (t or "").encode("utf-8").split(b"\n")  # a null row may share its id with others
                    stay = [x for x in lines if line_hash(x, min_chars) not in gone]
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay).decode("utf-8"))
                arrays = [rows.column(i) for i, f in enumerate(rows.schema) if f.name not in ("t", "gone")]
                names = [f.name for f in rows.schema if f.name not in ("t", "gone")]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
                    names=[*names, "n_lines", "n_dropped", "kept"])
    return run


class Runs:
    """Levelled runs of distinct hashes, each a table bucketed and sorted by hash."""

    def __init__(self, spark, buckets: int, fanout: int):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[DataFrame]] = []

    def all(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (bucketed by ``h``) whose hash is in no run: one anti-join per run, without a shuffle."""
        for level in self.levels:
            for run in level:
                keys = keys.join(run.select("h").hint("merge"), "h", "left_anti")
        return keys

    def add(self, run: DataFrame, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = reduce(DataFrame.unionByName, self.levels[level])
            self.levels[level] = []
            self.add(keep_bucketed(merged.repartition(self.buckets, "h"), f"lines_level{level + 1}", self.buckets, "h",
                                   sort=True), level + 1)


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                    batches: int = 4, fanout: int = 3) -> DataFrame:
    """(d, h): the line hashes that each document loses."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t"))
    cuts = rows.agg(F.percentile_approx("d", [k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    batch = reduce(lambda c, k: c.when(F.col("d") <= cuts[k], k), range(len(cuts)), F.when(F.lit(False), -1))
    path = shared(spark, "line-hashes")
    (rows.mapInArrow(_hashes(min_chars), "d long, h binary").withColumn("batch", batch.otherwise(len(cuts)))
     .write.option("compression", "zstd").partitionBy("batch").parquet(path))
    table = spark.read.schema("d long, h binary, batch int").parquet(path)
    n = partitions(spark)
    runs, marks = Runs(spark, n, fanout), []
    for k in range(len(cuts) + 1):
        keys = (table.where(F.col("batch") == k).groupBy("h")
                .agg(F.min("d").alias("first"), F.count(F.lit(1)).alias("n")).repartition(n, "h"))  # shuffled once, into the buckets
        keys = keep_bucketed(keys, "lines_batch", n, "h", sort=True)
        new = runs.unseen(keys)
        own = keep_bucketed(new, "lines_run", n, "h", sort=True)
        runs.add(own.select("h"))
        known = keys.join(own.select("h").hint("merge"), "h", "left_anti")
        # hashes of one document only (the bulk) take no part in the join back
        marks.append(keep(own.where("n > 1").withColumn("seen", F.lit(False)).unionByName(known.withColumn("seen", F.lit(True)))
                          .withColumn("batch", F.lit(k)), "line-marks"))
    all_marks = reduce(DataFrame.unionByName, marks).select("batch", "h", "first", "seen", "n")
    total = table.count()
    lost = F.col("seen") | (F.col("first").isNotNull() & (F.col("d").isNull() | (F.col("d") > F.col("first"))))
    hot = all_marks.where(F.col("n") > F.lit(total * HOT_SHARE))
    cold = all_marks.where(F.col("n") <= F.lit(total * HOT_SHARE))
    found = (table.join(F.broadcast(hot), ["batch", "h"])
             .unionByName(table.join(F.broadcast(hot.select("batch", "h")), ["batch", "h"], "left_anti")
                          .join(cold, ["batch", "h"])))
    return found.where(lost).select("d", "h")


def rebuilt_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                 batches: int = 4, fanout: int = 3) -> DataFrame:
    """row (struct of the documents' other columns), n_lines, n_dropped, kept (the text left) of every row."""
    gone = (duplicate_lines(docs, id_col, text_col, min_chars, batches, fanout)
            .groupBy(F.col("d").alias("gone_id")).agg(F.collect_set("h").alias("gone")))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("row"),
                       F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    # the lists are the built side: the texts are shuffled once and never sorted
    joined = rows.join(gone.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("gone_id")), "left").select("row", "t", "gone")
    schema = joined.select("row", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"),
                           F.lit("").alias("kept")).schema
    return joined.mapInArrow(_rebuild(min_chars), schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                batches: int = 4, fanout: int = 3) -> DataFrame:
    """The documents with the text that is left in place of the text; columns keep their order."""
    rows = rebuilt_rows(docs, id_col, text_col, min_chars, batches, fanout)
    return rows.select(*[F.col("kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])


def line_dedup_sql(docs: str = "documents", min_chars: int = 10) -> str:
    """DuckDB CTEs ending in ``rebuilt(doc_id, n_lines, n_dropped, kept)``."""
    space = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
    lines AS MATERIALIZED (
      SELECT doc_id, p.pos, p.line, translate(trim(p.line, {space}),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM {docs}) s,
           LATERAL (SELECT unnest(s.parts) AS line, generate_subscripts(s.parts, 1) AS pos) p),
    firsts AS (SELECT key, min(doc_id) AS first FROM lines WHERE length(key) >= {min_chars} GROUP BY key),
    marked AS (SELECT l.*, coalesce(l.doc_id > f.first, false) AS lost FROM lines l LEFT JOIN firsts f ON l.key = f.key),
    rebuilt AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
                  coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '') AS kept
                FROM marked GROUP BY doc_id)"""
