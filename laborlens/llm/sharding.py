"""Sharding by longest-processing-time scheduling over groups kept together.

Groups (equal texts) are sorted by size and dealt to the least-loaded bin
through a heap, in two levels so that no task sees all groups: each partition
of groups, streamed in descending size, fills a fixed number of bundles
through its own heap; the bundles (partitions x bundles rows) then go to the
shards by the same rule. A group larger than a shard's fair share stays whole
and alone decides how even the sizes can get.

Null texts have size 1 (no bytes plus 1) and group with empty texts; null ids
are ordinary rows; repeated rows share a group; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laborlens.llm.common import keep, partitions, prepare, text_or_empty

#: bundles that each partition of groups fills, per shard
BUNDLES_PER_SHARD = 4
#: a group with more than this share of all rows is joined by broadcast (at most 1/share such groups)
HOT_SHARE = 1 / 500


def least_loaded(sizes, bins: int) -> list[int]:
    """Bin of each size, taken in the given (descending) order."""
    heap = [(0, b) for b in range(bins)]
    out = []
    for s in sizes:
        load, b = heap[0]
        heapq.heapreplace(heap, (load + s, b))
        out.append(b)
    return out


def _bundler(bundles: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() * bundles
        heap = [(0, b) for b in range(bundles)]
        for batch in batches:
            out = []
            for s in batch.column("bytes").to_pylist():
                load, b = heap[0]
                heapq.heapreplace(heap, (load + s, b))
                out.append(base + b)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())],
                                             names=[*batch.schema.names, "bundle"])
    return deal


def lpt_shards(rows: DataFrame, key: str, size: str, n_shards: int) -> DataFrame:
    """(key, n, bytes, shard) of each group of ``rows``: equal ``key`` values stay together."""
    spark = rows.sparkSession
    prepare(spark)
    bundles = BUNDLES_PER_SHARD * n_shards
    groups = (rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"))
              .repartition(partitions(spark), "key").sortWithinPartitions(F.desc("bytes"), "key"))
    dealt = keep(groups.mapInArrow(_bundler(bundles), "key binary, n long, bytes long, bundle long"), "bundles")
    # one row per bundle: partitions x bundles, whatever the number of documents
    loads = (dealt.groupBy("bundle").agg(F.sum("bytes").alias("bytes"))
             .orderBy(F.desc("bytes"), "bundle").collect())
    shard = least_loaded([r.bytes for r in loads], n_shards)
    of = spark.createDataFrame([(r.bundle, s) for r, s in zip(loads, shard, strict=True)], "bundle long, shard int")
    return dealt.join(of, "bundle").select("key", "n", "bytes", "shard")


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: shards of near-equal bytes, equal texts together;
    ``slot`` numbers a shard's rows from 0 without gaps."""
    spark = docs.sparkSession
    prepare(spark)
    text = text_or_empty(F.col(text_col).cast("string"))
    rows = keep(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key")), "shard-rows")
    groups = keep(lpt_shards(rows, "key", "size", n_shards), "shard-groups")
    total = rows.count()
    # hot groups by broadcast (at most 1/HOT_SHARE rows), all others by a shuffle of small groups
    hot = groups.where(F.col("n") > total * HOT_SHARE).select("key", "shard")
    cold = groups.where(F.col("n") <= total * HOT_SHARE).select("key", "shard")
    placed = (rows.join(F.broadcast(hot), "key")
              .unionByName(rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(cold, "key")))
    # gapless slots: counts per (shard, bucket of ids), their prefix sums, and the place within the bucket
    n = partitions(spark)
    placed = keep(placed.drop("key").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n))),
                  "shard-placed")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("m"))
            .select("shard", "bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base")))
    within = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return (placed.withColumn("place", F.row_number().over(within) - 1).join(base, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place")).alias("slot")))
