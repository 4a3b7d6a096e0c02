"""Exact top-k by integer inner product: tiles of queries x candidates.

Vectors become integers ``floor(scale * x)``. Both sides are packed into
blocks of rows; a grid assigns every pair of (query group, candidate shard) one
cell, each holding a bounded number of blocks. A cell multiplies its tiles,
selects the best k of each tile per query and merges them; the cells' lists
are then merged level by level (``fan`` lists at a time) until one is left.

Products run in double precision while every partial sum stays below 2**53
(exact), in 64-bit integers below 2**63, and in Python integers beyond, cut to
the long range. Vectors that are null or hold null or non-finite components,
and rows without an id, take no part; a query meets only vectors of its own
length; rows with the query's id are never its candidates; ties go to the
smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborlens.llm.common import keep, prepare

BLOCK_ROWS = 2048
BLOCKS_PER_CELL = 8
FAN = 16
LONG = np.iinfo(np.int64)
BLOCK = "block long, dim int, ids binary, rows binary"
TOP = "query_id long, vec_id long, score long, shard long"


def _packer(scale: int, rows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held = TaskContext.get().partitionId(), 0, {}

        def block(dim: int, ids: list, vecs: list) -> pa.RecordBatch:
            nonlocal seq
            seq += 1
            v = np.floor(scale * np.asarray(vecs, dtype=np.float64).reshape(len(ids), dim))
            v = np.clip(v, -2.0 ** 63, np.nextafter(2.0 ** 63, 0)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + seq], pa.int64()), pa.array([dim], pa.int32()),
                 pa.array([np.asarray(ids, dtype="<i8").tobytes()], pa.binary()),
                 pa.array([v.astype("<i8").tobytes()], pa.binary())], names=["block", "dim", "ids", "rows"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, vecs = held.setdefault(len(v), ([], []))
                ids.append(i)
                vecs.append(v)
                if len(ids) == rows:
                    yield block(len(v), *held.pop(len(v)))
        for dim, (ids, vecs) in held.items():
            yield block(dim, ids, vecs)
    return pack


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of two blocks, as int64."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), dtype=np.int64)
    bound = max(abs(int(q.min())), int(q.max())) * max(abs(int(c.min())), int(c.max())) * q.shape[1]
    if bound < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return q @ c.T
    return np.clip(q.astype(object) @ c.astype(object).T, int(LONG.min), int(LONG.max)).astype(np.int64)


def best_of_tile(qid: np.ndarray, cid: np.ndarray, score: np.ndarray, k: int):
    """The k best (query, candidate, score) per query of one tile, ties to the smaller id."""
    own = qid[:, None] == cid[None, :]
    score = np.where(own, LONG.min, score)
    if score.shape[1] > k:
        least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        r, c = np.nonzero((score >= least[:, None]) & ~own)
    else:
        r, c = np.nonzero(~own)
    return _first_k(qid[r], cid[c], score[r, c], k)


def _first_k(q: np.ndarray, c: np.ndarray, s: np.ndarray, k: int):
    """Rows sorted by query, score descending, id; the first k of each query."""
    order = np.lexsort((c, ~s, q))  # ~s falls as s rises, without overflow
    q, c, s = q[order], c[order], s[order]
    if len(q):
        at = np.arange(len(q))
        first = np.maximum.accumulate(np.where(np.r_[True, q[1:] != q[:-1]], at, 0))
        q, c, s = (x[at - first < k] for x in (q, c, s))
    return q, c, s


def _cell(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        shard = left["shard"][0].as_py() if left.num_rows else 0
        for q in right.select(["dim", "ids", "rows"]).to_pylist():
            qid = np.frombuffer(q["ids"], "<i8")
            qv = np.frombuffer(q["rows"], "<i8").reshape(len(qid), q["dim"])
            best = None
            for i in range(left.num_rows):
                if left["dim"][i].as_py() != q["dim"]:
                    continue
                cid = np.frombuffer(left["ids"][i].as_py(), "<i8")
                cv = np.frombuffer(left["rows"][i].as_py(), "<i8").reshape(len(cid), q["dim"])
                tile = best_of_tile(qid, cid, products(qv, cv), k)
                best = tile if best is None else _first_k(*(np.concatenate(x) for x in zip(best, tile, strict=True)), k)
            if best is not None and len(best[0]):
                out.append(pa.table([*(pa.array(x, pa.int64()) for x in best),
                                     pa.array(np.full(len(best[0]), shard), pa.int64())],
                                    names=["query_id", "vec_id", "score", "shard"]))
        return pa.concat_tables(out) if out else pa.table(
            {c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score", "shard")})
    return run


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
               id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best candidates among all rows."""
    spark = vectors.sparkSession
    prepare(spark)
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    v = (vectors.withColumn("is_query", is_query)
         .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"), "is_query")
         .where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(sound))
    cand = keep(v.select("id", "vec").mapInArrow(_packer(scale, BLOCK_ROWS), BLOCK), "topk-candidates")
    # queries are few (their share of the table): spread them no further than blocks of rows need
    query = keep(v.where("is_query").select("id", "vec").coalesce(8).mapInArrow(_packer(scale, BLOCK_ROWS), BLOCK),
                 "topk-queries")
    shards = max(1, -(-cand.count() // BLOCKS_PER_CELL))
    groups = max(1, -(-query.count() // BLOCKS_PER_CELL))
    c = (cand.withColumn("shard", F.pmod(F.xxhash64("block"), F.lit(shards)))
         .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))))
    q = (query.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
         .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))))
    cell = F.col("shard") * groups + F.col("group")
    top = (c.withColumn("cell", cell).groupBy("cell").cogroup(q.withColumn("cell", cell).groupBy("cell"))
           .applyInArrow(_cell(k), TOP))
    # merge the cells' lists as a tree
    while shards > FAN:
        top = top.withColumn("shard", F.floor(F.col("shard") / FAN))
        w = Window.partitionBy("query_id", "shard").orderBy(F.desc("score"), "vec_id")
        top = top.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).drop("place")
        shards = -(-shards // FAN)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (top.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
