"""Mixing sources to target weights by weighted fair queueing, natively.

Every document may be taken in up to ``max_passes`` passes. In each pass a
source's documents stand in a shuffled order (md5 of pass, id and text). A copy's
virtual finish time is the words its source has sent up to and including it,
divided by the source's target; all copies are ordered by virtual finish time
and taken while the running total stays within the budget (the sum of the
targets).

Targets: sources in code point order (null last) weigh ``weights`` repeating
and share ``budget`` times all words; a target stops at ``max_passes`` times
its source's words and the excess is shared again by weight until none is
above, which is one water level over the sources sorted by (cap / weight).

Running totals never gather a source in one task: rows are dealt into buckets
of the sort key, summed per bucket, bucket sums are summed per ``FINE`` buckets,
and only rows of one bucket, sums of FINE buckets, or sums of those meet in a window.

Null and empty texts have size 0 and are taken 0 times; a null id sorts as the
text 'null'; rows repeated with one id are separate rows, ordered by their texts,
so that neither the rows' order nor their partitions change the result (rows of
one id, source and text are alike: which of them is taken is left open, how many
is not); a null source is a source of its own; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborlens.llm.common import keep, prepare, text_or_empty

ROWS_PER_BUCKET = 1_000
HAIR = 1e-13
#: buckets whose sums meet in one window
FINE = 1_000
MD5_PREFIX = 1 << 32  # the buckets cut the first 8 hexadecimal digits


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null counts 0."""
    t = text_or_empty(text)
    for space in "\t\n\x0b\x0c\r":
        t = F.replace(t, F.lit(space), F.lit(" "))
    # a split at one plain character needs no pattern matching
    return F.size(F.array_remove(F.split(t, " "), "")).cast("long")


def text_key(text: Column) -> Column:
    """What orders rows of one id: md5 of the whole text (null as empty)."""
    return F.md5(text_or_empty(text).cast("binary"))


def sums_before(sums: DataFrame, by: list[str], at: str, words: str, out: str) -> DataFrame:
    """``sums`` with ``out``: the words of all rows of the same ``by`` with smaller ``at``, over two levels."""
    coarse = sums.withColumn("_coarse", F.floor(F.col(at) / FINE))
    upper = Window.partitionBy(*by).orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1)
    totals = coarse.groupBy(*by, "_coarse").agg(F.sum(words).alias("_words"))
    totals = totals.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_coarse").alias("_c"),
                           F.coalesce(F.sum("_words").over(upper), F.lit(0)).alias("_base"))
    lower = Window.partitionBy(*by, "_coarse").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    inside = coarse.withColumn("_inside", F.coalesce(F.sum(words).over(lower), F.lit(0)))
    return (inside.join(totals, reduce(Column.__and__, same, F.col("_coarse") == F.col("_c")))
            .select(*sums.columns, (F.col("_base") + F.col("_inside")).alias(out)))


def source_targets(sized: DataFrame, weights=(5, 2, 1), budget: float = 1.5, max_passes: int = 2) -> DataFrame:
    """(source, source_size, target) of each source; one row per source meets in the windows."""
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]),
                     ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                      % len(weights) + 1).cast("int"))
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", w)
    s = s.withColumn("cap", F.col("source_size") * max_passes)
    everything = Window.partitionBy()
    # sources fill up in the order cap / weight (compared exactly as cap / weight of longs in double)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(budget)))
         .withColumn("all_weight", F.sum("weight").over(everything))
         .withColumn("full_caps", F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("full_weight", F.coalesce(F.sum("weight").over(before), F.lit(0)))
         # the level if exactly the sources before this one are full
         .withColumn("level", (F.col("total") - F.col("full_caps")) / (F.col("all_weight") - F.col("full_weight"))))
    # the first source that its level does not fill fixes the level for all after it
    fits = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
        F.col("full_weight").alias("at"), F.col("level").alias("level")))).over(everything)
    s = s.withColumn("fit", fits)
    target = (F.when(F.col("fit").isNull() | (F.col("full_weight") < F.col("fit.at")), F.col("cap").cast("double"))
              .otherwise(F.least(F.col("cap").cast("double"), F.col("fit.level") * F.col("weight"))))
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights=(5, 2, 1), budget: float = 1.5, max_passes: int = 2, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken, passes, row of every document."""
    prepare(docs.sparkSession)
    sized = keep(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                             word_count(F.col(text_col).cast("string")).alias("size"),
                             text_key(F.col(text_col).cast("string")).alias("text_key"),
                             F.monotonically_increasing_id().alias("row")), "mix-sized")
    return _take(sized, keep(source_targets(sized, weights, budget, max_passes), "mix-targets"), max_passes)


def mixed_documents(docs: DataFrame, weights=(5, 2, 1), budget: float = 1.5, max_passes: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents that the mix takes, each as often as it is taken; columns as they are."""
    prepare(docs.sparkSession)
    # numbered once and written, so that a row has one number in all that follows
    rows = keep(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("doc"),
                            F.monotonically_increasing_id().alias("row")), "mix-rows")
    sized = keep(rows.select(F.col("doc").getField(id_col).cast("long").alias("doc_id"),
                             F.col("doc").getField(source_col).cast("string").alias("source"),
                             word_count(F.col("doc").getField(text_col).cast("string")).alias("size"),
                             text_key(F.col("doc").getField(text_col).cast("string")).alias("text_key"), "row"), "mix-sized")
    taken = _take(sized, keep(source_targets(sized, weights, budget, max_passes), "mix-targets"), max_passes)
    times = taken.where("passes > 0").select("row", "passes")
    return (rows.join(times.hint("shuffle_hash"), "row")
            .select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes"))))
            .select(*[F.col("doc").getField(c).alias(c) for c in docs.columns]))


def _take(sized: DataFrame, targets: DataFrame, max_passes: int) -> DataFrame:
    buckets = max(1, sized.count() // ROWS_PER_BUCKET)
    # targets: one row per source
    rows = sized.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    copies = (rows.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max_passes - 1))))
              .where((F.col("size") > 0) & (F.col("target") > 0))
              .withColumn("mark", F.md5(F.concat_ws(":", F.col("pass").cast("string"), F.coalesce(
                  F.col("doc_id").cast("string"), F.lit("null")), "text_key").cast("binary")))
              .withColumn("bucket", F.col("pass") * buckets + F.floor(
                  F.conv(F.substring("mark", 1, 8), 16, 10).cast("long") * buckets / MD5_PREFIX)))
    # words sent by the source up to and including each copy
    sums = copies.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    base = sums_before(sums, ["source"], "bucket", "words", "sent").select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "sent")
    within = Window.partitionBy("source", "bucket").orderBy("mark", "row").rowsBetween(Window.unboundedPreceding, 0)
    sent = (copies.withColumn("inner", F.sum("size").over(within))
            .join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
            .withColumn("finish", (F.col("sent") + F.col("inner")) / F.col("target")))
    timed = keep(sent.select("row", "source", "pass", "mark", "size", "finish",
                             F.floor(F.col("finish") * buckets).alias("slot")), "mix-timed")
    # global order by virtual finish time, cut where the running total passes the budget
    slots = timed.groupBy("slot").agg(F.sum("size").alias("words"))
    # a sum of doubles differs in its last digits with the order of its rows: a hair more never cuts off a whole word
    total = targets.agg((F.sum("target") * (1 + HAIR) + 1e-6).alias("budget"))
    start = sums_before(slots.withColumn("all", F.lit(0)), ["all"], "slot", "words", "done").select(
        F.col("slot").alias("t"), "done")
    place = (Window.partitionBy("slot").orderBy("finish", F.col("source").asc_nulls_last(), "pass", "mark", "row")
             .rowsBetween(Window.unboundedPreceding, 0))
    taken = (timed.withColumn("inner", F.sum("size").over(place)).join(start, F.col("slot") == F.col("t"))
             .join(F.broadcast(total), F.col("done") + F.col("inner") <= F.col("budget"))  # one row
             .groupBy("row").agg(F.count(F.lit(1)).alias("passes")))
    return (sized.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
            .join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.coalesce("passes", F.lit(0))).alias("taken"),
                    F.coalesce("passes", F.lit(0)).alias("passes"), "row"))


def targets_sql() -> str:
    """DuckDB text of ``source_targets`` over a relation ``sized(source, size)``, as CTEs ending in ``targets``."""
    return """
    by_source AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                          WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight, 2 * source_size AS cap FROM by_source),
    levels AS (SELECT *, (SELECT sum(source_size) FROM weighed)::DOUBLE * 1.5::DOUBLE AS total,
                 coalesce(sum(cap) OVER o, 0)::DOUBLE AS full_caps, coalesce(sum(weight) OVER o, 0)::DOUBLE AS full_weight,
                 (SELECT sum(weight) FROM weighed)::DOUBLE AS all_weight
               FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / weight::DOUBLE, source NULLS LAST
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    leveled AS (SELECT *, (total - full_caps) / (all_weight - full_weight) AS level FROM levels),
    fit AS (SELECT full_weight AS fit_at, level AS fit_level FROM leveled WHERE level * weight <= cap
            ORDER BY full_weight, level LIMIT 1),
    targets AS (SELECT source, source_size, CASE WHEN fit_at IS NULL OR full_weight < fit_at THEN cap::DOUBLE
                  ELSE least(cap::DOUBLE, fit_level * weight) END AS target
                FROM leveled LEFT JOIN fit ON true)"""


def taken_sql() -> str:
    """DuckDB CTEs from ``sized(doc_id, source, size, text_key, row)`` and ``targets`` to ``taken(row, passes)``."""
    return """
    copies AS (SELECT z.row, z.doc_id, z.source, z.size, t.target, p.pass,
                 md5(p.pass::VARCHAR || ':' || coalesce(z.doc_id::VARCHAR, 'null') || ':' || z.text_key) AS mark
               FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) p(pass)
               WHERE z.size > 0 AND t.target > 0),
    sent AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY pass, mark, row
                                       ROWS UNBOUNDED PRECEDING)::DOUBLE / target AS finish FROM copies),
    running AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, pass, mark, row
                                          ROWS UNBOUNDED PRECEDING) AS words FROM sent),
    taken AS (SELECT row, count(*) AS passes FROM running WHERE words <= (SELECT sum(target) * (1 + 1e-13::DOUBLE) + 1e-6::DOUBLE FROM targets) GROUP BY row)"""


def mix_sql() -> str:
    return f"""
    WITH sized AS MATERIALIZED (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             md5(coalesce(text, '')) AS text_key, row_number() OVER (ORDER BY doc_id) AS row FROM documents),
    {targets_sql()},
    {taken_sql()}
    SELECT z.doc_id, z.size, t.source_size, t.target, (z.size * coalesce(k.passes, 0))::BIGINT AS taken
    FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source LEFT JOIN taken k ON z.row = k.row"""
