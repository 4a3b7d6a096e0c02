"""Registered queries: names and texts against tables that come from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from laborlens.catalog import sqlgen as S
from laborlens.catalog.registry import register
from laborlens.functions import dictionaries as D
from laborlens.operators.dictionary import Dictionary
from laborlens.operators.similarity_join import best_matches
from laborlens.session import materialise
from laborlens.sources import tables

BLANKS = r"[ \t\n]+"
WORD = 24  # characters of a word that a name keeps
START = 256  # characters of a text that are searched for its first words before the whole text is


def _words(spark, sf_dir):
    """(doc_id, source, w): the first two words of every document that has them."""
    # the start of a text will do where it holds two words and the blank behind them
    start = F.substring("text", 1, START)
    text = F.when(start.rlike(r"^ *[^ \t\n]+[ \t\n]+[^ \t\n]+[ \t\n]"), start).otherwise(F.col("text"))
    d = tables.read(spark, sf_dir, "documents").select("doc_id", "source", F.split(F.trim(text), BLANKS, 3).alias("_w"))
    return d.select("doc_id", "source", *[F.substring(F.get("_w", i), 1, WORD).alias(f"w{i + 1}") for i in (0, 1)]).where(
        "length(w1) > 1 and length(w2) > 1")


_WORDS_SQL = f"""
SELECT * FROM (SELECT doc_id, source, left(w[1], {WORD}) AS w1, left(w[2], {WORD}) AS w2 FROM (
  SELECT doc_id, source, regexp_split_to_array(trim(text, ' '), {S.q(BLANKS)}) AS w FROM documents))
WHERE length(w1) > 1 AND length(w2) > 1"""


@register("similarity_join_names", sql=lambda: f"""
WITH words AS MATERIALIZED ({_WORDS_SQL}),
canon AS MATERIALIZED (SELECT b, length(b) AS lb, (1::HUGEINT << length(b)) - 1 AS ones, pos, match,
         map_from_entries(list_transform(list_distinct(string_split(b, '')), lambda c: struct_pack(k := c,
           v := list_sum(list_transform(range(1, length(b) + 1), lambda i: CASE WHEN b[i] = c THEN 1::HUGEINT << (i - 1) ELSE 0::HUGEINT END))::HUGEINT))) AS masks
  FROM (SELECT b, min(pos) AS pos, arg_min(name, (pos, name)) AS match FROM (
    SELECT name, pos, {S.token_sort('name')} AS b FROM (SELECT w1 || ' ' || w2 AS name, min(doc_id) AS pos FROM words GROUP BY 1)) GROUP BY b)),
names AS MATERIALIZED (SELECT name, a, length(a) AS la FROM (SELECT name, {S.token_sort('name')} AS a FROM (
    SELECT DISTINCT substring(w2, 2) || ' ' || w1 || CASE WHEN doc_id % 3 = 0 THEN ' Ltd' ELSE '' END AS name FROM words))),
scored AS (SELECT name, match, pos, CASE WHEN a = b THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * (lb - bit_count(list_reduce(string_split(a, ''),
             lambda v, c: ((v + (v & coalesce(masks[c], 0::HUGEINT))) | (v - (v & coalesce(masks[c], 0::HUGEINT)))) & ones, ones))) / (la + lb) END AS score
           FROM names JOIN canon ON 200 * least(la, lb) >= {D.COMPANY_MATCH_CUTOFF} * (la + lb))
SELECT name, match, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, pos, match) AS _r FROM scored WHERE score >= {D.COMPANY_MATCH_CUTOFF})
WHERE _r = 1""", ops="J7 X1")
def q_similarity_join(spark, sf_dir):
    """Landed spellings (words swapped, a letter lost, a suffix) against
    the table of all names, through the indexed similarity join."""
    words = materialise(_words(spark, sf_dir).select("doc_id", "w1", "w2"), "similarity-words")  # the texts are read once
    canon = words.groupBy(F.concat_ws(" ", "w1", "w2").alias("name")).agg(F.min("doc_id").alias("priority"))
    suffix = F.when(F.col("doc_id") % 3 == 0, F.lit(" Ltd")).otherwise("")
    names = words.select(F.concat(F.expr("substring(w2, 2)"), F.lit(" "), "w1", suffix).alias("name"))
    return best_matches(names, canon).select("name", "match", F.round("score", 6).alias("score"))


@register("dictionary_mentions", sql=lambda: f"""
WITH dict AS MATERIALIZED (SELECT key, min(doc_id) AS priority, arg_min(source, doc_id) AS value
  FROM (SELECT lower(w2) AS key, doc_id, source FROM ({_WORDS_SQL}) WHERE length(w2) > 3) GROUP BY key),
texts AS MATERIALIZED (SELECT 'turn' AS src, conv_id * 1000 + turn AS id, lower(text) AS t FROM conversations
  UNION ALL SELECT 'document', doc_id, lower(text) FROM documents),
hits AS (SELECT src, id, key, value, priority, strpos(t, key) AS place FROM texts JOIN dict ON contains(t, key)),
found AS (SELECT src, id, count(*) AS n_keys, arg_min(key, (priority, key)) AS first_key, arg_min(value, (priority, key)) AS first_value,
                 arg_min(key, (place, -length(key))) AS earliest_key FROM hits GROUP BY src, id)
SELECT t.src, t.id, coalesce(n_keys, 0) AS n_keys, first_key, first_value, earliest_key
FROM texts t LEFT JOIN found f ON t.src = f.src AND t.id = f.id""", ops="X2 X3 X4 X7 X8 J8")
def q_dictionary_mentions(spark, sf_dir):
    """First match by priority, earliest mention and number of keys of every turn
    and document, against a dictionary that grows with the documents."""
    w = _words(spark, sf_dir).where("length(w2) > 3")
    table = w.groupBy(F.lower("w2").alias("key")).agg(F.min("doc_id").alias("priority"), F.min_by("source", "doc_id").alias("value"))
    turns = tables.read(spark, sf_dir, "conversations").select(
        F.lit("turn").alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lower("text").alias("t"))
    docs = tables.read(spark, sf_dir, "documents").select(F.lit("document").alias("src"), F.col("doc_id").alias("id"),
                                                          F.lower("text").alias("t"))
    texts = turns.unionByName(docs)
    found = Dictionary(table).match(texts, "t", "m")
    return found.select("src", "id", "m.n_keys", F.col("m.first.key").alias("first_key"), F.col("m.first.value").alias("first_value"),
                        F.col("m.earliest_key").alias("earliest_key"))
