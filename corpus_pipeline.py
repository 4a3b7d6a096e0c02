"""Corpus pipeline: documents in, token digests of the mixed corpus out.

Five stages, each working on everything that the one before kept; a stage's
result is written as Parquet and read back as the next one's input:

1. quality       documents that the quality classifier rejects go
2. line_dedup    lines seen in an earlier document go, and documents that keep none of
                 their lines; ``n_chars`` follows the text
3. near_dedup    one document of each near-duplicate group stays
4. mixing        documents are taken as often as the mix to target weights takes them
5. bpe           ids and decoded text of every document taken, as digests

Edge cases are those of the operators (see their modules): null texts are empty
after line dedup, rows without an id are never duplicates, an empty table goes
through all stages, further columns of documents pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens.llm.bpe_table import encode_decode
from laborlens.llm.common import keep, load
from laborlens.llm.line_dedup import rebuilt_rows
from laborlens.llm.minhash import drop_near_duplicates
from laborlens.llm.mixing import mixed_documents
from laborlens.llm.quality import filter_quality
from laborlens.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return filter_quality(docs, load(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = rebuilt_rows(docs).where((F.col("kept") != "") | (F.col("n_dropped") == 0))
    text = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return rows.select(*[text.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = encode_decode(docs, tokenizer_file("byte_bpe_50k.json"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("bpe", bpe)]

#: the classifier can't be said in SQL; tests run the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
