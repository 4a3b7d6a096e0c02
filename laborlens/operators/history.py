"""Rolling company history and trend.

State is a long table (keys..., date, hiring, layoffs, score) with at most
``points`` dates per key, so every per-key step below touches <= points + 1
rows whatever the data size: windows over a key are bounded by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborlens.functions import dictionaries as D

STATE_SCHEMA = "company string, city string, date string, hiring bigint, layoffs bigint, score bigint"


def snapshot_rows(gold: DataFrame, as_of_date: Column, keys=("company", "city"),
                  hiring="hiring", layoffs="layoffs") -> DataFrame:
    """Today's entry per key: date, hiring, layoffs, score = hiring - layoffs."""
    return gold.select(*[F.col(k) for k in keys],
                       F.date_format(as_of_date, "yyyy-MM-dd").alias("date"),
                       F.col(hiring).cast("bigint").alias("hiring"),
                       F.col(layoffs).cast("bigint").alias("layoffs"),
                       (F.col(hiring) - F.col(layoffs)).cast("bigint").alias("score"))


def update_history(state: DataFrame, snapshot: DataFrame, keys: Sequence[str] = ("company", "city"),
                   points: int = D.HISTORY_POINTS) -> DataFrame:
    """V1: union, one entry per (key, date) with the new snapshot replacing a
    same-date entry, then the ``points`` most recent dates per key."""
    keys = list(keys)
    both = (state.select(*keys, "date", "hiring", "layoffs", "score", F.lit(0).alias("_prio"))
            .unionByName(snapshot.select(*keys, "date", "hiring", "layoffs", "score", F.lit(1).alias("_prio"))))
    one_per_date = (both.groupBy(*keys, "date")
                    .agg(F.max(F.struct("_prio", "hiring", "layoffs", "score")).alias("_e"))
                    .select(*keys, "date", "_e.hiring", "_e.layoffs", "_e.score"))
    w = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    return (one_per_date.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= points).drop("_rn"))


def trend(history: DataFrame, keys: Sequence[str] = ("company", "city"), out: str = "trend") -> DataFrame:
    """V2: per key, scores in date order scaled to 5..100:
    max(5, min(100, floor((s - min) / rng * 95) + 5)), rng = max - min or 1."""
    keys = list(keys)
    w = Window.partitionBy(*keys)
    mn, mx = F.min("score").over(w), F.max("score").over(w)
    rng = F.when(mx - mn == 0, F.lit(1)).otherwise(mx - mn)
    scaled = F.greatest(F.lit(D.TREND_MIN), F.least(
        F.lit(D.TREND_MAX), F.floor((F.col("score") - mn) / rng * D.TREND_SPAN).cast("int") + D.TREND_MIN))
    pts = history.withColumn("_t", scaled)
    return (pts.groupBy(*keys)
            .agg(F.array_sort(F.collect_list(F.struct("date", "_t"))).alias("_pts"))
            .select(*keys, F.transform("_pts", lambda e: e.getField("_t")).alias(out)))


def mark_new(snapshot: DataFrame, prior_state: DataFrame, keys: Sequence[str] = ("company", "city"),
             out: str = "is_new") -> DataFrame:
    """``is_new`` = the key has no entry in the prior state (marker left join
    against the distinct prior keys)."""
    keys = list(keys)
    seen = prior_state.select(*keys).distinct().withColumn("_seen", F.lit(True))
    return (snapshot.join(seen, keys, "left")
            .withColumn(out, F.col("_seen").isNull()).drop("_seen"))
