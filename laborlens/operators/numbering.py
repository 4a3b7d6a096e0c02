"""Global row numbers without a single-partition window (K2 chunking).

Rows are range-partitioned on the order column (the engine samples the bounds;
as many ranges as the session shuffles to, which follows the data), numbered
inside their partition, and written with the partition's number; exclusive
prefix sums over one count per partition turn local into global numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laborlens.session import materialise


def global_row_number(df: DataFrame, order_col: str, out: str = "row_num") -> tuple[DataFrame, int]:
    """(df with 1-based ``out`` = position in ascending ``order_col``, total rows).
    ``order_col`` must be orderable and unique."""
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialise(df.repartitionByRange(ranges, order_col).withColumn("_range", F.spark_partition_id()), "numbering")
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(order_col))
    numbered = (dealt.withColumn("_local", local).join(bases, "_range")
                .select(*df.columns, (F.col("_base") + F.col("_local")).alias(out)))
    return numbered, dealt.count()


def chunk_records(df: DataFrame, order_col: str, chunk_size: int = 500) -> DataFrame:
    """K2: ``chunk`` = (position - 1) div chunk_size and the chunk's ``record_count``
    (all chunks are full except the last, so the count is arithmetic)."""
    numbered, total = global_row_number(df, order_col, "_pos")
    chunk = F.floor((F.col("_pos") - 1) / chunk_size).cast("int")
    return (numbered.withColumn("chunk", chunk)
            .withColumn("record_count", F.least(F.lit(chunk_size), F.lit(total) - F.col("chunk") * chunk_size)
                        .cast("bigint"))
            .drop("_pos"))
