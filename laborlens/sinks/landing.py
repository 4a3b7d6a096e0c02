"""Bronze landing (K1, K2) and gold table writes.

Envelopes are bounded: rows are numbered inside the task that holds them, per
layout key, and every ``max_records`` of them make one envelope. No record
field decides where a row goes, so repeated or empty ids, a skewed source or
city change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlens.operators.numbering import chunk_records


def bounded_groups(df: DataFrame, keys: Sequence[str], id_col: str, max_records: int = 500) -> DataFrame:
    """Add ``_task`` and ``_bucket``: rows of one task and layout key, in runs of at most ``max_records``."""
    df = df.withColumn("_task", F.spark_partition_id())
    w = Window.partitionBy(*keys, "_task").orderBy(id_col)
    return df.withColumn("_bucket", F.floor((F.row_number().over(w) - 1) / max_records).cast("int"))


def _stamped(df: DataFrame, run_ts: str, batch_ts: str) -> DataFrame:
    stamp = F.to_timestamp(F.lit(batch_ts))
    return (df.withColumn("batch_ts", F.lit(batch_ts)).withColumn("run_id", F.lit(run_ts))
            .withColumn("year", F.date_format(stamp, "yyyy")).withColumn("month", F.date_format(stamp, "MM"))
            .withColumn("day", F.date_format(stamp, "dd")).withColumn("hour", F.date_format(stamp, "HH"))
            .withColumn("run", F.lit(run_ts)))


def _packer(keys: Sequence[str], array_field: str, max_records: int, hold_rows: int = 65_536, hold_bytes: int = 64 << 20):
    """Rows of a task as envelopes (for ``mapInArrow``), without a shuffle: rows are held until there are
    ``hold_rows`` (or ``hold_bytes``) of them, their full envelopes go out, and the rest of each key is
    held on; if the rests alone are that many, they go out too."""
    def pack(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def envelopes(rows, short):
            """(envelopes, rows held on): in key order, by id inside a key; ``short``: those not full too."""
            rows = rows.take(pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in [*keys, "_id"]])).combine_chunks()
            n = len(rows)
            new = np.arange(n) == 0
            for k in keys:
                code = rows[k].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                new[1:] |= code[1:] != code[:-1]
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, n))
            place = np.arange(n) - np.repeat(start, size)
            out = np.full(n, True) if short else place < np.repeat(size // max_records * max_records, size)
            ready, cut = rows.filter(pa.array(out)), np.flatnonzero(place[out] % max_records == 0)
            ends = pa.array(np.append(cut, len(ready)), pa.int32())
            lists = pa.ListArray.from_arrays(ends, ready["_rec"].combine_chunks()) if len(ready) else None
            made = None if lists is None else pa.RecordBatch.from_arrays(
                [*[ready[k].combine_chunks().take(pa.array(cut)) for k in keys], lists], names=[*keys, array_field])
            return made, rows.filter(pa.array(~out))

        held, n, size = [], 0, 0
        for batch in batches:
            held, n, size = [*held, batch], n + len(batch), size + batch.nbytes
            if n < hold_rows and size < hold_bytes:
                continue
            made, rest = envelopes(pa.Table.from_batches(held), False)
            if made is not None:
                yield made
            if 2 * len(rest) >= hold_rows or 2 * rest.nbytes >= hold_bytes:
                yield envelopes(rest, True)[0]
                rest = rest.slice(0, 0)
            held, n, size = rest.to_batches(), len(rest), rest.nbytes
        if n:
            yield envelopes(pa.Table.from_batches(held), True)[0]
    return pack


def land_envelopes(records: DataFrame, path: str, partition_cols: dict[str, Column], id_col: str, array_field: str,
                   count_field: str, run_ts: str, batch_ts: str, max_records: int = 500) -> None:
    """K1: land records as JSON envelopes ``{batch_ts, run_id, <count_field>, <array_field>: [...]}``
    under ``<partition_cols>/year=/month=/day=/hour=/run=``, compressed (``.json.gz``). A run that is landed again
    replaces its own folders; those of other runs stay."""
    keys = list(partition_cols)
    keyed = records.select(*[e.cast("string").alias(k) for k, e in partition_cols.items()],
                           F.struct(*records.columns).alias("_rec"), F.col(id_col).alias("_id"))
    packed = keyed.mapInArrow(_packer(keys, array_field, max_records), T.StructType(
        [*keyed.schema.fields[:len(keys)], T.StructField(array_field, T.ArrayType(keyed.schema["_rec"].dataType))]))
    env = _stamped(packed.withColumn(count_field, F.size(array_field)), run_ts, batch_ts)
    order = [k for k in keys if k == "source"] + ["year", "month", "day", "hour"] + [k for k in keys if k != "source"] + ["run"]
    (env.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
     .partitionBy(*order).json(path))


def land_chunked(records: DataFrame, path: str, source: str, order_col: str, run_ts: str, batch_ts: str,
                 chunk_size: int = 500) -> None:
    """K2: records in ascending ``order_col`` as envelopes of ``chunk_size`` that carry their
    chunk index and the number of records and chunks, under
    ``source=/year=/month=/day=/hour=/run=`` with one part folder per chunk."""
    order = chunk_records(records, order_col, chunk_size)
    env = (order.groupBy("chunk").agg(F.first("record_count").alias("record_count"), F.collect_list(
        F.struct(*records.columns)).alias("records")).withColumn("chunk_index", F.col("chunk")))
    chunks = order.agg(F.max("chunk") + 1).first()[0] or 0
    env = _stamped(env.withColumn("chunk_count", F.lit(chunks)).withColumn("source", F.lit(source)), run_ts, batch_ts)
    (env.withColumn("part", F.format_string("%06d", "chunk")).drop("chunk").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("source", "year", "month", "day", "hour", "run", "part").json(path))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Overwrite a plain table (a fresh path per run; never the path being read): for
    tables that readers follow from run to run see ``sinks.snapshots``."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
