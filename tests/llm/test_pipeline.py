"""The pipeline's stages against brute force on small tables, and the registered SQL."""

import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from laborlens.llm import quality
from laborlens.llm.queries import ORACLES, QUERIES, tokenizer_file
from llm_data import SF, edges, empty, generated, texts_of
from test_dedup import brute_components, brute_lines


def test_all_queries_are_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14)) and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    plain = lambda x: round(x, 6) if isinstance(x, float) else x
    assert sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr) == sorted(
        (tuple(map(plain, r)) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("table", [edges, generated, empty])
def test_stages(spark, table):
    docs = table(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    stage = dict(corpus_pipeline.STAGES)
    assert names == ["quality", "line_dedup", "near_dedup", "mixing", "bpe"]
    # quality: exactly the rows whose score reaches the threshold
    good = stage["quality"](spark, docs, SF)
    assert good.columns == docs.columns
    scores = quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert good.count() == scores.where(F.col("predicted") == 1).count()
    good = spark.createDataFrame(good.collect(), docs.schema)
    # line dedup
    lines = stage["line_dedup"](spark, good, SF)
    assert lines.columns == docs.columns
    lines = spark.createDataFrame(lines.collect(), docs.schema)
    left = [(i, k) for i, _, dropped, k in brute_lines(texts_of(good)) if k or not dropped]  # emptied documents go
    assert sorted(texts_of(lines), key=repr) == sorted(left, key=repr)
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    # near dedup
    near = spark.createDataFrame(stage["near_dedup"](spark, lines, SF).collect(), docs.schema)
    want = [r for r, (_, _, _, kept) in zip(texts_of(lines), brute_components(texts_of(lines)), strict=True) if kept]
    assert sorted(texts_of(near), key=repr) == sorted(want, key=repr)
    # mixing: whole documents, none more than twice
    mixed = spark.createDataFrame(stage["mixing"](spark, near, SF).collect(), docs.schema)
    assert mixed.columns == docs.columns and set(texts_of(mixed)) <= set(texts_of(near))
    # bpe
    lib = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    lib.no_truncation()
    got = sorted((tuple(r) for r in stage["bpe"](spark, mixed, SF).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in texts_of(mixed):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert got == sorted(want, key=repr)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
