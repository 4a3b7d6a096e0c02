"""State-to-city payroll split (J6 + Y8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_by_city(df: DataFrame, state_cities: DataFrame, state: str = "state", value: str = "value") -> DataFrame:
    """Each state value becomes one row per city of the state (default: the state
    itself): ``floor(v / n)`` each, the first city also gets ``v mod n`` (floor
    semantics, so the parts always sum back to ``v``, negatives included).
    ``state_cities`` is (state, cities array) and is bounded by the dictionary."""
    joined = df.join(state_cities.withColumnRenamed("state", "_s"), F.col(state) == F.col("_s"), "left")
    cities = F.coalesce(F.col("cities"), F.array(F.col(state)))
    n = F.size(cities).cast("bigint")
    v = F.col(value).cast("bigint")
    rem = F.pmod(v, n)
    share = (v - rem) / n
    return (joined.select(*[F.col(c) for c in df.columns], F.posexplode(cities).alias("_pos", "city"),
                          share.cast("bigint").alias("_share"), rem.alias("_rem"))
            .withColumn("city_value", F.when(F.col("_pos") == 0, F.col("_share") + F.col("_rem"))
                        .otherwise(F.col("_share")))
            .drop("_share", "_rem"))
