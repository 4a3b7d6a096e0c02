"""Landing/reading round trips and streaming jobs on small literal data."""

import pytest
from pyspark.sql import functions as F

from laborlens import schemas
from laborlens.functions import dictionaries as D
from laborlens.sinks.landing import bounded_groups, land_envelopes
from laborlens.sources import bronze
from laborlens.streaming import incremental as Z

NEWS_ROWS = [
    ("Acme lays off 1,200 employees", "", "Acme", "Pune", "1,200", "layoff", "2024-01-05T10:00:00Z", "u1", "f", "api", "2024-01-05T11:00:00Z"),
    ("Acme lays off 1,200 employees", "", "Acme", "Pune", "1,200", "layoff", "2024-01-05T10:00:00Z", "u1", "f", "api", "2024-01-05T12:00:00Z"),
    ("Beta is hiring", "", "Beta", "Mumbai", "50", "hiring", "Sat, 06 Jan 2024 09:00:00 GMT", "u2", "f", "rss", "2024-01-06T10:00:00Z"),
    ("Beta is hiring again", "", "Beta", "Mumbai", "5000.0", "hiring", "2024-01-07T09:00:00Z", "u3", "f", "api", "2024-01-07T10:00:00Z"),
]


def news_df(spark):
    return spark.createDataFrame(NEWS_ROWS, schemas.NEWS)


def test_bounded_groups_split_hot_key(spark):
    df = spark.range(2000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("id"))
    b = bounded_groups(df, ["k"], "id", max_records=500)
    sizes = [r["count"] for r in b.groupBy("_task", "_bucket").count().collect()]
    assert max(sizes) <= 500 and sum(sizes) == 2000


def test_envelopes_are_bounded_whatever_the_id(spark, tmp_path):
    root = str(tmp_path / "one-id")
    rows = spark.range(2600).select(F.lit("t").alias("title"), F.lit("same").alias("url")).coalesce(1)
    land_envelopes(rows, root, {"source": F.lit("news")}, "url", "records", "record_count", "r", "2024-01-31T06:00:00Z")
    sizes = [r.n for r in bronze.read_envelopes(spark, root, schemas.NEWS).select(F.size("records").alias("n")).collect()]
    assert sum(sizes) == 2600 and max(sizes) == 500


def test_envelope_forms(spark, tmp_path):
    """Pretty-printed, one-line, several lines, empty records beside jobs, corrupt: nothing is lost or hidden."""
    import json
    folder = tmp_path / "source=news" / "run=r1"
    folder.mkdir(parents=True)
    rec = lambda u, h: {"title": u, "url": u, "headcount": h}
    env = lambda *r: {"batch_ts": "b", "run_id": "r", "records": list(r)}
    (folder / "a.json").write_text(json.dumps(env(rec("a", "1,200"), rec("b", 5000.0)), indent=2))
    (folder / "b.json").write_text(json.dumps(env(rec("c", 1200))))
    (folder / "c.json").write_text(json.dumps(env(rec("d", None))) + "\n" + json.dumps(env(rec("e", 3))) + "\n{broken\n")
    (folder / "d.json").write_text(json.dumps({"run_id": "r", "records": [], "jobs": [rec("f", 4)]}))
    (folder / "e.json").write_text("{ not json at all")
    got = {r.url: r.headcount for r in bronze.load_source(spark, str(tmp_path), "news", schemas.NEWS).collect()}
    assert got == {"a": "1,200", "b": "5000.0", "c": "1200", "d": None, "e": "3", "f": "4"}
    assert tuple(bronze.envelope_counts(spark, str(tmp_path), "news", schemas.NEWS).first()) == ("news", 5, 2, 6)


def test_envelope_forms_in_the_stream(spark, tmp_path):
    """The stream reads what the batch reader reads, and keeps and counts the rest."""
    import json
    import warnings
    folder = tmp_path / "landed" / "source=news" / "run=r1"
    folder.mkdir(parents=True)
    rec = lambda u, h: {"title": u, "url": u, "headcount": h}
    env = lambda *r: {"batch_ts": "b", "run_id": "r", "records": list(r)}
    (folder / "a.json").write_text(json.dumps(env(rec("a", "1,200"), rec("b", 5000.0)), indent=2))
    (folder / "b.json").write_text(json.dumps(env(rec("c", 1200))))
    (folder / "c.json").write_text(json.dumps(env(rec("d", None))) + "\n" + json.dumps(env(rec("e", 3))) + "\n{broken\n")
    (folder / "d.json").write_text(json.dumps({"run_id": "r", "records": [], "jobs": [rec("f", 4)]}, indent=2))
    (folder / "e.json").write_text("{ not json\n at all")
    (folder / "g.json").write_text(json.dumps([env(rec("g", 5)), env(rec("h", 6))]))
    root, out, ck = str(tmp_path / "landed"), str(tmp_path / "out"), str(tmp_path / "ck")
    Z.run_to_parquet(Z.news_stream(spark, root), out, ck)
    got = {r.url: r.headcount for r in spark.read.parquet(out).collect()}
    assert got == {"a": "1,200", "b": "5000.0", "c": "1200", "d": None, "e": "3", "f": "4", "g": "5", "h": "6"}
    bad, bad_ck = str(tmp_path / "bad"), str(tmp_path / "bad-ck")
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert Z.keep_unreadable(spark, root, bad, bad_ck) == 2
        assert Z.keep_unreadable(spark, root, bad, bad_ck) == 2  # nothing new has landed
    assert any("can't be read" in str(w.message) for w in told)
    kept = {(r._file.rsplit("/", 1)[1], r._corrupt_record) for r in spark.read.parquet(bad).collect()}
    assert kept == {("c.json", "{broken"), ("e.json", "{ not json\n at all")}


def test_land_and_read_envelopes(spark, tmp_path):
    root = str(tmp_path / "bronze")
    land_envelopes(news_df(spark), root, {"source": F.lit("news")}, "url", "records", "record_count",
                   "run1", "2024-01-31T06:00:00Z")
    land_envelopes(news_df(spark).limit(1), root, {"source": F.lit("news")}, "url", "records", "record_count",
                   "run2", "2024-02-01T06:00:00Z")
    back = bronze.load_source(spark, root, "news", schemas.NEWS)
    assert back.count() == 5  # every run ever landed is read
    runs = {r.landed_run: r["count"] for r in back.groupBy("landed_run").count().collect()}
    assert runs == {"run1": 4, "run2": 1}
    counts = {r.landed_source: r.records for r in bronze.source_counts(back).collect()}
    assert counts == {"news": 5}


def test_a_date_range_opens_only_its_folders(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for day in (29, 30, 31):
        land_envelopes(news_df(spark).limit(day - 28), root, {"source": F.lit("news"), "city": F.col("city")}, "url", "records",
                       "record_count", f"run{day}", f"2024-01-{day}T06:00:00Z")
    load = lambda **kw: bronze.load_source(spark, root, "news", schemas.NEWS, **kw)
    one = load(since="2024-01-30", until="2024-01-30")
    assert one.count() == 2 and {r.landed_day for r in one.collect()} == {"30"}
    assert all("/day=30/" in f for f in one.inputFiles()) and len(load().inputFiles()) > len(one.inputFiles())
    assert load(since="2024-01-30", until="2024-02-02").count() == 5 and load().count() == 6
    none = load(since="2023-01-01", until="2023-01-03")
    assert none.count() == 0 and none.columns == one.columns
    with pytest.raises(ValueError):
        load(since="2024-01-30")


def test_stream_dedupe_and_history(spark, tmp_path):
    root = str(tmp_path / "landed")
    land_envelopes(news_df(spark), root, {"source": F.lit("news"), "city": F.col("city")}, "url", "records",
                   "record_count", "run1", "2024-01-31T06:00:00Z")
    silver = Z.silver_news_stream(Z.news_stream(spark, root, max_files=1), D.CANONICAL_COMPANIES, D.CITY_ALIASES)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    Z.run_to_parquet(Z.dedupe_stream(silver), out, ck)
    assert sorted(r.url_key for r in spark.read.parquet(out).collect()) == ["u1", "u2", "u3"]
    # a second run over the same landing reads nothing new (checkpointed)
    Z.run_to_parquet(Z.dedupe_stream(Z.silver_news_stream(Z.news_stream(spark, root), D.CANONICAL_COMPANIES,
                                                          D.CITY_ALIASES)), out, ck)
    assert spark.read.parquet(out).count() == 3
    state, ck2 = str(tmp_path / "state"), str(tmp_path / "ck2")
    Z.history_upsert(silver, state, ck2)
    hist = {(r.company, r.date): (r.hiring, r.layoffs) for r in Z.latest_state(spark, state).collect()}
    assert hist == {("Acme", "2024-01-05"): (0, 2400), ("Beta", "2024-01-06"): (50, 0),
                    ("Beta", "2024-01-07"): (5000, 0)}


def test_daily_signals_by_company_and_reported_drops(spark, tmp_path):
    """Counts keep companies apart whatever the file order; late, undated and old rows are counted."""
    import os
    old = ("Old", "", "Acme", "Pune", "5", "layoff", "2023-11-01T10:00:00Z", "u9", "f", "api", "2024-01-09T10:00:00Z")
    undated = ("Undated", "", "Beta", "Pune", "5", "layoff", "soon", "u8", "f", "api", "2024-01-09T10:00:00Z")
    root = str(tmp_path / "landed")
    for i, rows in enumerate((NEWS_ROWS[2:], NEWS_ROWS[:2], [old, undated])):  # rows are late by the watermark two batches before
        land_envelopes(spark.createDataFrame(rows, schemas.NEWS).coalesce(1), root, {"source": F.lit("news")}, "url",
                       "records", "record_count", f"run{i}", "2024-01-31T06:00:00Z")
        for d, _, names in os.walk(f"{root}/source=news"):
            for name in names:
                if f"run{i}" in d:
                    os.utime(f"{d}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    silver = lambda **kw: Z.silver_news_stream(Z.news_stream(spark, root, max_files=1), D.CANONICAL_COMPANIES,
                                               D.CITY_ALIASES, **kw)
    out = str(tmp_path / "daily")
    Z.daily_signals(silver(), out, str(tmp_path / "daily-ck"))
    got = {(r.company_norm, str(r.day), r.signal_type): r.articles for r in Z.read_daily_signals(spark, out).collect()}
    assert got == {("Acme", "2023-11-01", "layoff"): 1, ("Acme", "2024-01-05", "layoff"): 2,
                   ("Beta", "2024-01-06", "hiring"): 1, ("Beta", "2024-01-07", "hiring"): 1}
    assert Z.run_to_parquet(Z.dedupe_stream(silver()), str(tmp_path / "z2"), str(tmp_path / "z2-ck")) == 1
    as_of = F.to_timestamp(F.lit("2024-01-31 06:00:00"))
    assert Z.run_to_parquet(Z.dedupe_stream(silver(as_of=as_of)), str(tmp_path / "b6"), str(tmp_path / "b6-ck")) == 0
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "b6")).collect()) == ["u1", "u2", "u3"]
    dropped = Z.keep_dropped(Z.news_stream(spark, root), str(tmp_path / "dropped"), str(tmp_path / "dropped-ck"), as_of)
    assert dropped == {"published_at": 1, "window": 1}


def test_history_survives_a_lost_commit(spark, tmp_path):
    """A batch repeated because its commit was lost gives the same state; a fresh checkpoint adds to the old state."""
    import os
    root, state, ck = (str(tmp_path / x) for x in ("landed", "state", "ck"))
    land_envelopes(news_df(spark), root, {"source": F.lit("news"), "city": F.col("city")}, "url", "records",
                   "record_count", "run1", "2024-01-31T06:00:00Z")
    silver = lambda: Z.silver_news_stream(Z.news_stream(spark, root), D.CANONICAL_COMPANIES, D.CITY_ALIASES)
    rows = lambda: sorted(tuple(r) for r in Z.latest_state(spark, state).collect())
    Z.history_upsert(silver(), state, ck)
    once = rows()
    for name in os.listdir(f"{ck}/commits"):
        os.remove(f"{ck}/commits/{name}")
    Z.history_upsert(silver(), state, ck)
    assert rows() == once
    Z.history_upsert(silver(), state, str(tmp_path / "other"))
    assert [r[3:5] for r in rows()] == [tuple(2 * x for x in r[3:5]) for r in once]


def test_micro_batches_follow_bytes_not_files(spark, tmp_path):
    """many small landed files are one micro-batch (they were four files each)."""
    import os
    root, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    for i in range(9):
        land_envelopes(news_df(spark).coalesce(1), root, {"source": F.lit("news")}, "url", "records", "record_count", f"run{i}",
                       "2024-01-31T06:00:00Z")
    Z.run_to_parquet(Z.news_stream(spark, root), str(tmp_path / "out"), ck)
    assert len([n for n in os.listdir(f"{ck}/commits") if n.isdigit()]) == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9 * len(NEWS_ROWS)


def test_documents_are_computed_once(spark, tmp_path):
    """the header counts what was written (the rows were computed again for it)."""
    from laborlens.sinks import documents as K
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    rows = spark.range(40, numPartitions=2).select("id", (F.col("id") < 3).alias("is_new")).mapInPandas(note, "id long, is_new boolean")
    K.write_lines_document(rows, str(tmp_path / "d"), "r", "2024-01-31", new_flag="is_new")
    back = K.read_lines_document(spark, str(tmp_path / "d"), "id long, is_new boolean")
    assert seen.value == 40 and back.count() == 40 and tuple(back.first())[2:] == (40, 3)


def test_landing_moves_no_rows_and_reads_once(spark, tmp_path):
    """envelopes are packed in the task that holds the rows, and files are compressed."""
    import os
    root = str(tmp_path / "in")
    rows = spark.range(3000, numPartitions=2).select(F.col("id").cast("string").alias("url"), (F.col("id") % 3).cast("string").alias("city"),
                                                     F.lit(None).cast("string").alias("title"))
    land_envelopes(rows, root, {"source": F.lit("news"), "city": F.when(F.col("city") != "2", F.col("city"))}, "url", "records",
                   "record_count", "r", "2024-01-31T06:00:00Z", max_records=100)
    files = [n for _, _, names in os.walk(root) for n in names if n.startswith("part-")]
    assert len(files) == 6 and all(n.endswith(".json.gz") for n in files)  # one per task and city
    back = bronze.load_source(spark, root, "news", schemas.NEWS)
    assert "Join" not in back._jdf.queryExecution().optimizedPlan().toString()  # no pretty-printed file: lines alone are read
    assert sorted(int(r.url) for r in back.collect()) == list(range(3000))
    sizes = [r.n for r in bronze.read_envelopes(spark, root, schemas.NEWS).select(F.size("records").alias("n")).collect()]
    assert sorted(set(sizes)) == [100] and len(sizes) == 30
