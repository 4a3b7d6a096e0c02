"""Bronze reads (A1-A4, A10, A11): landed JSON envelopes with declared schemas.

The landed layout is ``source=<s>/year=/month=/day=/hour=[/city=]/run=*.json``
and one source adds a ``run=<id>/part_NNNN.json`` level, so Hive partition
inference over the root conflicts; reads therefore use
``recursiveFileLookup`` with a declared schema and recover the layout keys
from ``_metadata.file_path``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlens import schemas
from laborlens.session import materialise

LAYOUT_KEYS = ["source", "year", "month", "day", "hour", "city", "run"]


def day_folders(spark: SparkSession, path: str, since: str, until: str) -> list[str]:
    """The landed folders below ``path`` of the days from ``since`` to ``until`` (ISO dates, both
    included) that exist: one look at the file system per day, no listing of other days."""
    first, last = dt.date.fromisoformat(since), dt.date.fromisoformat(until)
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    names = [f"{path}/year={d:%Y}/month={d:%m}/day={d:%d}" for d in days]
    return [n for n in names if path_exists(spark, n)]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


CORRUPT = "_corrupt_record"


def _read_json(spark: SparkSession, path: str | Sequence[str], record: T.StructType, whole_file: bool) -> DataFrame:
    schema = schemas.any_envelope(record).add(T.StructField(CORRUPT, T.StringType()))
    return (spark.read.schema(schema).option("recursiveFileLookup", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", str(whole_file).lower()).json(path if isinstance(path, str) else list(path))
            .withColumn("_file", F.col("_metadata.file_path")))


def read_envelopes(spark: SparkSession, path: str | Sequence[str], record: T.StructType,
                   multiline: bool | None = None) -> DataFrame:
    """A1: every envelope under ``path`` (all runs ever landed; or several folders), plus layout keys
    and ``_corrupt_record`` (the text of an envelope that can't be read, else null).

    ``multiline``: true if each file is one (pretty-printed) envelope, false if
    each line is one; by default each file is taken as what it is: a file of
    which some line is an envelope is read line by line, any other file that
    has unreadable lines as one envelope."""
    if multiline is not None:
        df = _read_json(spark, path, record, multiline)
    else:
        lines = _read_json(spark, path, record, False)
        envelope = F.col(CORRUPT).isNull() & (F.col("records").isNotNull() | F.col("jobs").isNotNull())
        # the corrupt text itself must be read for Spark to fill it, hence materialised by the aggregate's input
        kinds = (lines.select("_file", envelope.alias("good"), F.col(CORRUPT).isNotNull().alias("bad"), *["records", "jobs", CORRUPT])
                 .groupBy("_file").agg(F.max("good").alias("good"), F.max("bad").alias("bad")))
        # found once, and no longer than the file listing that the driver has anyway, hence broadcast
        pretty = materialise(kinds.where("bad and not good").select("_file"), "pretty-files")
        df = lines
        if not pretty.isEmpty():
            df = (lines.join(F.broadcast(pretty), "_file", "left_anti")
                  .unionByName(_read_json(spark, path, record, True).join(F.broadcast(pretty), "_file", "left_semi")))
    keys = [F.regexp_extract("_file", f"/{k}=([^/]+)", 1).alias(f"_{k}") for k in LAYOUT_KEYS]
    return df.select(*[c for c in df.columns if c != "_file"], *keys)


def unnest_records(envelopes: DataFrame, record: T.StructType) -> DataFrame:
    """A2: the ``records`` array, or the ``jobs`` array where records is missing or
    empty, else nothing; one row per record."""
    arr = F.when(F.size("records") > 0, F.col("records")).otherwise(F.col("jobs"))
    keys = [f"_{k}" for k in LAYOUT_KEYS if f"_{k}" in envelopes.columns]
    out = envelopes.select(*keys, F.col("run_id"), F.col("batch_ts"), F.explode(arr).alias("_r"))
    return out.select(*[F.col(f"_r.{f.name}").alias(f.name) for f in record.fields],
                      *[F.col(k).alias(f"landed{k}") for k in keys], "run_id", "batch_ts")


def load_source(spark: SparkSession, root: str, source: str, record: T.StructType,
                multiline: bool | None = None, since: str | None = None, until: str | None = None) -> DataFrame:
    """A1-A3: one source's records; a source that never landed is an empty
    relation with the declared schema (not a column-less frame). With ``since``
    and ``until`` (ISO dates, both or none) only the folders of these days are
    listed and opened, whatever else has landed."""
    if (since is None) != (until is None):
        raise ValueError("give both since and until, or none")
    path: str | list[str] = f"{root.rstrip('/')}/source={source}"
    there = path_exists(spark, path)
    if there and since is not None:
        path = day_folders(spark, path, since, until)
        there = bool(path)
    if not there:
        empty = spark.createDataFrame([], record)
        for k in LAYOUT_KEYS:
            empty = empty.withColumn(f"landed_{k}", F.lit(None).cast("string"))
        return empty.withColumn("run_id", F.lit(None).cast("string")).withColumn("batch_ts", F.lit(None).cast("string"))
    return unnest_records(read_envelopes(spark, path, record, multiline), record)


def envelope_counts(spark: SparkSession, root: str, source: str, record: T.StructType,
                    multiline: bool | None = None) -> DataFrame:
    """A4: one row per source of what was landed: envelopes read, envelopes that
    can't be read, records."""
    env = read_envelopes(spark, f"{root.rstrip('/')}/source={source}", record, multiline)
    n = F.greatest(F.size("records"), F.lit(0))
    n = F.when(n > 0, n).otherwise(F.greatest(F.size("jobs"), F.lit(0)))
    return env.agg(F.lit(source).alias("landed_source"), F.count_if(F.col(CORRUPT).isNull()).alias("envelopes"),
                   F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt"),
                   F.coalesce(F.sum(F.when(F.col(CORRUPT).isNull(), n)), F.lit(0)).cast("bigint").alias("records"))


def source_counts(df: DataFrame, col: str = "landed_source") -> DataFrame:
    """A4: records per source."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("records"))


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Landed files with sizes (content is not read: only path/length are selected)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.{json,json.gz}").load(root).select("path", "length"))
