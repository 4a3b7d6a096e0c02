"""Top-k distinct values per group without unbounded groups.

1. distinct (group, value) by aggregation (partial agg absorbs hot groups);
2. rank inside (group, salt) and keep k  - a hot group is split S ways;
3. collect the <= k*S survivors per group, sort, slice to k.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_distinct(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[Column],
                   k: int, out: str, salt_buckets: int = 16) -> DataFrame:
    """Per ``keys``: array of up to ``k`` distinct non-null ``value`` s, ranked by
    the ascending ``order`` tuple of each value's best row (then the value)."""
    keys = list(keys)
    ranked = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value)
              .agg(F.min(F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])).alias("_ord")))
    salt = F.pmod(F.xxhash64(F.col(value)), F.lit(salt_buckets))
    w = Window.partitionBy(*keys, "_salt").orderBy("_ord", value)
    survivors = (ranked.withColumn("_salt", salt)
                 .withColumn("_rn", F.row_number().over(w))
                 .where(F.col("_rn") <= k))
    packed = F.struct(F.col("_ord").alias("o"), F.col(value).alias("v"))
    return (survivors.groupBy(*keys)
            .agg(F.slice(F.array_sort(F.collect_list(packed)), 1, k).alias("_top"))
            .select(*keys, F.transform("_top", lambda e: e.getField("v")).alias(out)))
