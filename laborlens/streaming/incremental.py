"""Structured Streaming jobs over landed bronze files.

All jobs read the landed envelope files with a declared schema, run with
``trigger(availableNow=True)`` (process what has landed, then stop), and keep
their checkpoints in the shared checkpoint folder, so a restarted job resumes
exactly where it stopped.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laborlens import schemas
from laborlens.functions import dictionaries as D
from laborlens.functions.dates import cutoff_date, parse_published
from laborlens.functions.scoring import signal_score_tenths
from laborlens.functions.similarity import with_company_norm
from laborlens.functions.text import normalise_city, parse_count
from laborlens.operators import history as H
from laborlens.operators.dedupe import keep_first, news_url_key
from laborlens.sinks.snapshots import SnapshotTable
from laborlens.sources.bronze import CORRUPT


#: landed (compressed) input of a micro-batch, so that their number follows the bytes landed, not the number of files
BATCH_BYTES = 256 << 20


def envelope_stream(spark: SparkSession, landed: str, max_files: int | None = None) -> DataFrame:
    """Landed news files as a stream of envelopes (A1): ``_file``, the envelope's
    fields and ``_corrupt_record`` (the text that can't be read, else null).

    Each file is taken as what it is, by the rule of the batch reader: a file of
    which some line is an envelope is read line by line, any other file that has
    unreadable lines as one (pretty-printed) envelope. A file is one row until
    its form is known, so it must fit a string (2 GB; a larger one fails the job).

    A micro-batch takes files of about ``BATCH_BYTES`` together, or with ``max_files``
    that many files."""
    schema = schemas.any_envelope(schemas.NEWS).add(T.StructField(CORRUPT, T.StringType()))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}

    def parse(body: Column) -> Column:
        unreadable = F.struct(*[(body if f.name == CORRUPT else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
        many = F.from_json(body, T.ArrayType(schema), options)
        return (F.when(body.rlike(r"^\s*\["), F.coalesce(many, F.array(unreadable)))
                .otherwise(F.array(F.from_json(body, schema, options))))

    def bad(e: Column) -> Column:
        return e.getField(CORRUPT).isNotNull()

    def good(e: Column) -> Column:
        return ~bad(e) & (e.getField("records").isNotNull() | e.getField("jobs").isNotNull())

    bound = ("maxBytesPerTrigger", BATCH_BYTES) if max_files is None else ("maxFilesPerTrigger", max_files)
    files = (spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true")
             .option(*bound).load(landed)
             .select(F.col("_metadata.file_path").alias("_file"), "value"))
    lines = F.filter(F.split("value", "\r\n|\r|\n"), lambda line: line.rlike(r"\S"))
    by_line = files.withColumn("_lines", F.flatten(F.transform(lines, parse)))
    pretty = F.exists("_lines", bad) & ~F.exists("_lines", good)
    env = by_line.select("_file", F.explode(F.when(pretty, parse(F.col("value"))).otherwise(F.col("_lines"))).alias("e"))
    return env.select("_file", "e.*")


def news_stream(spark: SparkSession, landed: str, max_files: int | None = None) -> DataFrame:
    """Landed news envelopes as a stream of records (A1/A2 in streaming form);
    ``keep_unreadable`` keeps and counts the envelopes that give no records
    because they can't be read."""
    arr = F.when(F.size("records") > 0, F.col("records")).otherwise(F.col("jobs"))
    return envelope_stream(spark, landed, max_files).select(F.explode(arr).alias("r")).select("r.*")


def keep_unreadable(spark: SparkSession, landed: str, out: str, checkpoint: str, max_files: int | None = None) -> int:
    """Keep the envelopes that can't be read (``_file``, text) as parquet files under
    ``out``; their number so far, with a warning if there are any."""
    env = envelope_stream(spark, landed, max_files).where(F.col(CORRUPT).isNotNull()).select("_file", CORRUPT)
    run_to_parquet(env, out, checkpoint)
    n = spark.read.schema(env.schema).parquet(out).count()
    if n:
        warnings.warn(f"{n} landed envelopes under {landed} can't be read; kept in {out}", stacklevel=2)
    return n


def _checked(records: DataFrame, as_of: Column | None, window_days: int) -> DataFrame:
    """Records with ``published_ts`` and ``_reason``, why silver drops the row (null: it stays):
    signal_type (B5), published_at (Y2, no date) or window (B6, only with ``as_of``)."""
    df = records.withColumn("published_ts", parse_published("published_at"))
    reason = (F.when(~F.coalesce(F.col("signal_type").isin(*D.SIGNAL_TYPES), F.lit(False)), F.lit("signal_type"))
              .when(F.col("published_ts").isNull(), F.lit("published_at")))
    if as_of is not None:
        reason = reason.when(F.to_date("published_ts") < cutoff_date(as_of, window_days), F.lit("window"))
    return df.withColumn("_reason", reason)


def silver_news_stream(records: DataFrame, canonical, city_aliases, as_of: Column | None = None,
                       window_days: int = 30) -> DataFrame:
    """Per-record silver steps (X1 per row, X2, Y2, B5, Y4, url key), and B6 if
    ``as_of`` is given; ``keep_dropped`` keeps and counts the rows left out."""
    kept = _checked(records, as_of, window_days).where(F.col("_reason").isNull()).drop("_reason")
    df = with_company_norm(kept, "company", "company_norm", canonical)
    return (df.withColumn("city", normalise_city("city", city_aliases))
            .withColumn("headcount", parse_count("headcount"))
            .withColumn("score_tenths", signal_score_tenths("signal_type", "headcount"))
            .withColumn("url_key", news_url_key("url", "title", "company")))


def keep_dropped(records: DataFrame, out: str, checkpoint: str, as_of: Column | None = None,
                 window_days: int = 30) -> dict[str, int]:
    """Keep the records that the silver stream leaves out (with ``_reason``) as
    parquet files under ``out``; their number so far by reason."""
    dropped = _checked(records, as_of, window_days).where(F.col("_reason").isNotNull())
    run_to_parquet(dropped, out, checkpoint)
    back = records.sparkSession.read.schema(dropped.schema).parquet(out)
    return {r["_reason"]: r["count"] for r in back.groupBy("_reason").count().collect()}


def dedupe_stream(silver: DataFrame, delay: str = "30 days") -> DataFrame:
    """URL-key dedupe with state bounded by the event-time watermark; rows
    older than the watermark are late and dropped, which depends on the order of
    the landed files (``run_to_parquet`` counts them)."""
    return silver.withWatermark("published_ts", delay).dropDuplicatesWithinWatermark(["url_key"])


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> int:
    """Run a streaming frame to completion (availableNow) into parquet files; the
    number of late rows this run dropped, with a warning if there are any."""
    return run_counting_late(df.writeStream.format("parquet").option("path", out).outputMode(mode), checkpoint)


def run_counting_late(writer, checkpoint: str) -> int:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    late: dict[int, int] = {}
    done = False
    while not done:  # only the latest progress reports are kept, so they are taken as the job goes
        done = q.awaitTermination(1)
        late.update({p["batchId"]: sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]) for p in q.recentProgress})
    n = sum(late.values())
    if n:
        warnings.warn(f"{n} rows were older than the watermark and dropped", stacklevel=3)
    return n


def daily_signal_counts(silver: DataFrame) -> DataFrame:
    """Z3: article counts per company, day and signal type."""
    return (silver.groupBy(F.to_date("published_ts").alias("day"), F.col("company_norm"), "signal_type")
            .agg(F.count(F.lit(1)).alias("articles"), F.sum("score_tenths").cast("bigint").alias("score_tenths")))


def daily_signals(silver: DataFrame, out: str, checkpoint: str) -> None:
    """Z3: each micro-batch writes its own counts as a part named by run and batch; a
    repeated batch writes its part again. The stream holds no state, so no row
    is late and no watermark is needed."""
    run = run_number(silver.sparkSession, out, checkpoint)

    def sink(batch: DataFrame, batch_id: int) -> None:
        daily_signal_counts(batch).write.mode("overwrite").parquet(f"{out}/v={run:08d}-{batch_id:08d}")
    q = (silver.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_daily_signals(spark: SparkSession, out: str) -> DataFrame:
    """The counts of all parts, one row per company, day and signal type."""
    schema = "day date, company_norm string, signal_type string, articles long, score_tenths long"
    return (spark.read.schema(schema).parquet(f"{out}/v=*").groupBy("day", "company_norm", "signal_type")
            .agg(F.sum("articles").alias("articles"), F.sum("score_tenths").alias("score_tenths")))


U2_ORDER = ["scraped_at", "published_ts", "title"]


def earliest_copies(rows: DataFrame) -> DataFrame:
    """Rows of several state folders -> the rows that stand for them: per URL key the one that batch ``keep_first`` keeps."""
    return keep_first(rows, ["url_key"], U2_ORDER)


def run_earliest(silver: DataFrame, out: str, checkpoint: str, keep_days: int | None = 30, grace_days: int = 365, fanout: int = 4) -> None:
    """Z2 as U2 has it: per URL key the row that batch ``keep_first`` keeps, whatever the order in
    which files land. The keyed state is log-structured (``SnapshotTable.upsert`` under
    ``out/kept``): a batch adds the smallest row of each of its keys, full levels are merged,
    and no row costs a call of its own.

    A row more than ``keep_days`` older than the newest of the run's batches before is late: it
    changes nothing and stays in the side table ``out/arrived`` (``read_late``), which has the
    rows of each batch. All late rows are kept there, those beyond ``grace_days`` too. With
    ``keep_days`` None no row is late: every row takes part, however old it is. A
    repeated batch writes its folders again and builds on the versions before its own."""
    spark = silver.sparkSession
    run = run_number(spark, f"{out}/kept", checkpoint)
    table = SnapshotTable(spark, f"{out}/kept")
    columns = [c for c in silver.columns if c != "late"]

    def clock(version: str):
        """The newest time of this run's batches before; null in the first one."""
        fs, folder, _ = _folder(spark, f"{out}/clock")
        if not fs.exists(folder):
            return None
        before = spark.read.schema("newest timestamp, version string").parquet(f"{out}/clock/v=*")
        return before.where(F.col("version").startswith(f"{run:08d}-") & (F.col("version") < version)).agg(F.max("newest")).first()[0]

    def sink(batch: DataFrame, batch_id: int) -> None:
        version = f"{run:08d}-{batch_id:08d}"
        late = F.lit(False)
        if keep_days is not None:
            oldest = F.lit(clock(version)).cast("timestamp") - F.make_dt_interval(days=F.lit(keep_days))
            late = F.coalesce(F.col("published_ts") < oldest, F.lit(False))
        arrived = f"{out}/arrived/v={version}"
        batch.select(*columns, late.alias("late")).write.mode("overwrite").partitionBy("late").parquet(arrived)
        rows = _arrived(spark, out, f"v={version}", silver.select(*columns).schema)
        table.upsert(rows.where(~F.col("late")).drop("late"), version, earliest_copies, fanout)
        newest = rows.agg(F.max("published_ts").alias("newest")).withColumn("version", F.lit(version))
        newest.write.mode("overwrite").parquet(f"{out}/clock/v={version}")
    q = silver.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _arrived(spark: SparkSession, out: str, versions: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("late", T.BooleanType())])
    return spark.read.schema(whole).option("basePath", out).parquet(f"{out}/arrived/{versions}")


def read_earliest(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """One row per URL key: the state that ``run_earliest`` keeps, merged over its folders."""
    return earliest_copies(SnapshotTable(spark, f"{out}/kept").read(schema=schema)).select(*schema.fieldNames())


def read_late(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The side table of late rows."""
    return _arrived(spark, out, "v=*", schema).where(F.col("late")).select(*schema.fieldNames())


def windowed_signals(silver: DataFrame, out: str, checkpoint: str, width: str = "1 day", delay: str = "400 days") -> int:
    """Z3 with event-time state: tumbling ``width`` windows per company and signal type, held
    until the watermark (``delay`` behind the newest row) passes them. Each batch writes
    the windows that changed, under its own name, so a repeated batch changes nothing.
    Returns the number of rows too late for their window."""
    spark = silver.sparkSession
    run = run_number(spark, out, checkpoint)
    counts = (silver.withWatermark("published_ts", delay)
              .groupBy(F.window("published_ts", width).alias("w"), "company_norm", "signal_type")
              .agg(F.count(F.lit(1)).alias("articles"), F.sum("score_tenths").cast("bigint").alias("score_tenths"))
              .select(F.col("w.start").alias("window_start"), "company_norm", "signal_type", "articles", "score_tenths"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        version = f"{run:08d}-{batch_id:08d}"
        batch.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{out}/v={version}")
    return run_counting_late(counts.writeStream.foreachBatch(sink).outputMode("update"), checkpoint)


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    """The newest counts of every window, company and signal type."""
    schema = "window_start timestamp, company_norm string, signal_type string, articles long, score_tenths long, version string"
    rows = spark.read.schema(schema).parquet(f"{out}/v=*")
    return (rows.groupBy("window_start", "company_norm", "signal_type")
            .agg(F.max(F.struct("version", "articles", "score_tenths")).alias("e"))
            .select("window_start", "company_norm", "signal_type", "e.articles", "e.score_tenths"))


def merged_history(points: int = D.HISTORY_POINTS):
    """Rows of several state folders -> the rows that stand for them: sums per key and day,
    the ``points`` latest days per key. Cutting early is safe: a day with that many
    later ones in some folders has them in all."""
    def merge(rows: DataFrame) -> DataFrame:
        sums = (rows.groupBy("company", "city", "date").agg(F.sum("hiring").alias("hiring"), F.sum("layoffs").alias("layoffs"))
                .withColumn("score", F.col("hiring") - F.col("layoffs")))
        return H.update_history(sums.limit(0), sums, points=points)
    return merge


def history_upsert(silver: DataFrame, state_root: str, checkpoint: str, points: int = D.HISTORY_POINTS, fanout: int = 4) -> None:
    """Per micro-batch, add the batch's per-(company, city, day) sums to the state.
    The state is log-structured (``SnapshotTable.upsert``): a batch writes the keys it
    changes, full levels are merged, and ``read_history`` merges the rest on read. A
    batch that is repeated after a lost commit builds on the version before its own,
    so its sums count once."""
    spark = silver.sparkSession
    run = run_number(spark, state_root, checkpoint)
    table = SnapshotTable(spark, state_root)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        hc = F.coalesce("headcount", F.lit(0))
        entries = (batch.groupBy(F.col("company_norm").alias("company"), "city",
                                 F.date_format("published_ts", "yyyy-MM-dd").alias("date"))
                   .agg(F.sum(F.when(F.col("signal_type") == "hiring", hc).otherwise(0)).cast("bigint").alias("hiring"),
                        F.sum(F.when(F.col("signal_type") == "layoff", hc).otherwise(0)).cast("bigint").alias("layoffs")))
        table.upsert(entries, f"{run:08d}-{batch_id:08d}", merged_history(points), fanout)
    q = (silver.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_history(spark: SparkSession, state_root: str, points: int = D.HISTORY_POINTS) -> DataFrame:
    """The history that ``history_upsert`` keeps, merged over its folders."""
    return merged_history(points)(SnapshotTable(spark, state_root).read(schema=schemas.HISTORY))


def _folder(spark: SparkSession, path: str):
    """(Hadoop file system, path object, its class) of a shared folder."""
    cls = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p = cls(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, cls


def run_number(spark: SparkSession, state_root: str, checkpoint: str) -> int:
    """Number of this checkpoint's run over the state: kept beside the checkpoint, so
    a restart goes on with it; a fresh checkpoint takes the next free number, so
    its versions come after all that exist."""
    fs, mark, cls = _folder(spark, f"{checkpoint}-run")
    if fs.exists(mark):
        return int(fs.listStatus(mark)[0].getPath().getName())
    root = cls(state_root)
    folders = [root, cls(f"{state_root}/_commits")]
    names = [st.getPath().getName() for f in folders if fs.exists(f) for st in fs.listStatus(f)]
    names = [v.removeprefix("v=") for v in names]
    n = 1 + max([int(v[:8]) for v in names if v[:8].isdigit() and v[8:9] == "-"], default=0)
    fs.mkdirs(cls(f"{checkpoint}-run/{n}"))
    return n


def latest_state(spark: SparkSession, state_root: str, before: str | None = None) -> DataFrame:
    """The newest finished state version under ``state_root`` (empty state if none);
    ``before``: the newest one whose name sorts before it, which is what a
    run that may be a repetition builds on."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(state_root)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return spark.createDataFrame([], schemas.HISTORY)
    if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{state_root}/_commits")):  # kept by history_upsert
        return merged_history()(SnapshotTable(spark, state_root).read(before=before, schema=schemas.HISTORY))
    versions = sorted(st.getPath().getName() for st in fs.listStatus(root) if st.getPath().getName().startswith("v="))
    done = [v for v in versions if (before is None or v < f"v={before}") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{state_root}/{v}/_SUCCESS"))]
    if not done:
        return spark.createDataFrame([], schemas.HISTORY)
    return spark.read.schema(schemas.HISTORY).parquet(f"{state_root}/{done[-1]}")
