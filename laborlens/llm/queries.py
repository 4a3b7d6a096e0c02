"""Registered queries of the operators, and the SQL of those that SQL can express.

Each query runs its operator over the whole table and derives the digest
columns from the operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens.llm import byte_bpe, merkle, periodic_runs
from laborlens.llm.bpe_table import encode_decode
from laborlens.llm.common import load, prepare, shared
from laborlens.llm.fingerprint import edited_fingerprints
from laborlens.llm.line_dedup import line_dedup_sql, rebuilt_rows
from laborlens.llm.minhash import near_duplicates
from laborlens.llm.mixing import mix, mix_sql
from laborlens.llm.quality import quality_scores
from laborlens.llm.sharding import shard_documents
from laborlens.llm.suffix_dedup import remove_repeats
from laborlens.llm.token_files import read_token_files, write_token_files
from laborlens.llm.topk import exact_topk

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_file(name: str) -> str:
    """Place of an installed public vocabulary file (the same path on every machine)."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    path = shared(spark, "tokens")
    write_token_files(docs, path, tokenizer_file("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_documents(load(spark, sf_dir, "documents"), n_shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuilt_rows(load(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return exact_topk(vectors, F.col("vec_id") % 50 == 0, k=5)


@query
def op6_bpe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_decode(load(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """op11's input: where 10 divides h = crc32(doc_id), a text of n > 0 words repeats from
    word a = g % n on with period p = 1 + floor((n - a) / (3 + g % 8)), g = floor(h / 10)."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = docs.where(h % 10 == 0).select("doc_id", periodic_runs.words_of("text").alias("w"), F.floor(h / 10).alias("g"))
    words = words.select("doc_id", "w", F.size("w").alias("n"), "g")
    a = (F.col("g") % F.greatest("n", F.lit(1))).cast("int")
    p = (1 + F.floor((F.col("n") - a) / (3 + F.col("g") % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil((F.col("n") - a) / p).cast("int")))
    text = F.array_join(F.concat(F.slice("w", F.lit(1), a), F.slice(tail, F.lit(1), F.col("n") - a)), " ")
    return docs.where(h.isNull() | (h % 10 != 0)).select("doc_id", "text").unionByName(words.select("doc_id", text.alias("text")))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs.periodic_runs(with_repeats(load(spark, sf_dir, "documents")), keep_cols=["doc_id"])
    rows = rows.select("row", "runs", "collapsed", periodic_runs.strongest(F.col("runs")).alias("top"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return rows.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = tokenizer_file("byte_bpe_50k.tiktoken")
    rows = byte_bpe.encode_decode(load(spark, sf_dir, "documents"), vocab, keep_cols=["doc_id"])
    return rows.select("row.doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    claimed = merkle.leaf_digest(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, claimed)
    manifest = merkle.build_manifest(docs, FIELDS, "lang", "doc_id", [F.col("doc_id"), tampered.alias("claimed")])
    rows = merkle.verified_proofs(spark, manifest, F.coalesce(F.col("carry.claimed"), F.col("leaf")))
    return rows.select("carry.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
                       "folded_root", "verified")


ORACLES["op4_line_dedup"] = f"""
    WITH {line_dedup_sql()}
    SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM rebuilt"""
ORACLES["op5_exact_topk"] = """
    WITH v AS MATERIALIZED (
      SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5"""
ORACLES["op8_mixing"] = mix_sql()
ORACLES["op13_merkle_manifest"] = merkle.manifest_sql()
