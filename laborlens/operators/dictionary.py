"""Dictionary matching of texts by one automaton per dictionary.

A dictionary is a table (key, value, priority). An Aho-Corasick automaton over
its keys reads each text once, whatever the number of keys, and gives

* ``first``: the entry with the smallest priority among the keys contained
  (then the smaller key) - the CASE chain of aliases, keywords or known names;
* ``earliest``: the entry mentioned earliest, the longest key at that place;
* ``n_keys``: how many different keys the text contains.

The table may come from data. Its size is checked: up to ``max_bytes`` of keys
and values make one automaton, sent to the tasks as a broadcast; a larger table
is dealt into as many parts as needed, matched one after the other, and the
parts' results are merged (a key lies in one part, so nothing is counted twice).

Keys are compared as they are (lower both sides first for a match in any case).
Null keys match nothing; an empty key is contained in every text, at its start;
of entries with one key the smallest priority (then the smallest value) counts.
Null texts match nothing; an empty dictionary matches nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborlens.session import materialise

RESULT = ("first struct<priority:bigint,key:string,value:string>, earliest struct<at:bigint,size:bigint,key:string,value:string>, "
          "n_keys bigint")
MAX_BYTES = 32 << 20


def _ship_by_value() -> None:
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _automaton(entries: Sequence[tuple[str, str, int]]):
    import ahocorasick
    words = ahocorasick.Automaton()
    for n, (key, _, _) in enumerate(entries):
        if key:
            words.add_word(key, n)
    words.make_automaton()
    return words


def match_text(text: str | None, words, entries: Sequence[tuple[str, str, int]], always: Sequence[int]):
    """(first, earliest, n_keys) of one text, None if it holds no key."""
    if text is None:
        return None
    found, place = set(always), None
    best = min((((0, 0), n) for n in always), default=None)
    if len(words):
        for end, n in words.iter(text):
            found.add(n)
            size = len(entries[n][0])
            place = (end - size + 1, -size)
            if best is None or place < best[0] or (best[0][1] == 0 and place[0] == 0):
                best = (place, n)
    if not found:
        return None
    first = min(found, key=lambda n: (entries[n][2], entries[n][0]))
    (at, size), n = best
    return ((entries[first][2], entries[first][0], entries[first][1]), (at, -size, entries[n][0], entries[n][1]), len(found))


def _matcher(entries):
    """UDF of text -> RESULT over a broadcast list of (key, value, priority) with distinct keys."""
    _ship_by_value()

    @F.pandas_udf(RESULT)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = entries.value
        if not hasattr(entries, "automaton"):  # a worker process keeps its broadcasts: built once in each
            entries.automaton = _automaton(table)
        words, always = entries.automaton, [n for n, e in enumerate(table) if not e[0]]
        for texts in batches:
            rows = [match_text(t, words, table, always) for t in texts]
            yield pd.DataFrame({
                "first": [None if r is None else {"priority": r[0][0], "key": r[0][1], "value": r[0][2]} for r in rows],
                "earliest": [None if r is None else {"at": r[1][0], "size": r[1][1], "key": r[1][2], "value": r[1][3]} for r in rows],
                "n_keys": [0 if r is None else r[2] for r in rows]})
    return match


class Dictionary:
    """A dictionary table made ready for matching."""

    def __init__(self, table: DataFrame, max_bytes: int = MAX_BYTES):
        spark = table.sparkSession
        one = F.min(F.struct(F.col("priority").cast("long").alias("priority"), F.col("value").cast("string").alias("value")))
        keyed = materialise(table.where("key is not null").groupBy(F.col("key").cast("string").alias("key"))
                            .agg(one.alias("e")).select("key", "e.value", "e.priority"), "dictionary")
        size = F.octet_length("key") + F.coalesce(F.octet_length("value"), F.lit(0))
        held = keyed.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]  # one number
        self.parts = max(1, -(-held // max_bytes))
        part = F.pmod(F.xxhash64("key"), F.lit(self.parts))
        # each collect is bounded: a part holds max_bytes on average, its share of the table
        self.matchers = [_matcher(spark.sparkContext.broadcast([tuple(r) for r in keyed.where(part == p).collect()]))
                         for p in range(self.parts)]

    def match(self, df: DataFrame, text: Column | str, out: str) -> DataFrame:
        """``df`` with the struct ``out`` (first, earliest, n_keys); the structs are null where nothing matches."""
        text = F.col(text) if isinstance(text, str) else text
        results = [f"_{out}_{p}" for p in range(self.parts)]
        for name, matcher in zip(results, self.matchers, strict=True):
            df = df.withColumn(name, matcher(text))
        # smallest priority, then key; earliest place, then the longest key: nulls are left out by least
        first = _least([F.col(f"{r}.first") for r in results])
        earliest = _least([F.struct(F.col(f"{r}.earliest.at"), (-F.col(f"{r}.earliest.size")).alias("less"),
                                    F.col(f"{r}.earliest.key"), F.col(f"{r}.earliest.value")) for r in results],
                          [F.col(f"{r}.earliest").isNotNull() for r in results])
        n_keys = sum((F.col(f"{r}.n_keys") for r in results), F.lit(0).cast("long"))
        found = F.struct(first.alias("first"), earliest.getField("key").alias("earliest_key"),
                         earliest.getField("value").alias("earliest_value"), n_keys.alias("n_keys"))
        return df.withColumn(out, found).drop(*results)


def _least(columns: list[Column], there: list[Column] | None = None) -> Column:
    if there is not None:
        columns = [F.when(t, c) for t, c in zip(there, columns, strict=True)]
    return F.least(*columns) if len(columns) > 1 else columns[0]


def alias_table(spark: SparkSession, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Entries of an ordered list of (key, value), the order as priority."""
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(pairs)], "key string, value string, priority long")


def keyword_table(spark: SparkSession, groups: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Entries of ordered (label, words) groups: a group's words share its place."""
    return spark.createDataFrame([(w, label, i) for i, (label, words) in enumerate(groups) for w in words],
                                 "key string, value string, priority long")
