"""Versioned tables, log-structured history, and streaming state that expires."""

import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from laborlens import schemas
from laborlens.functions import dictionaries as D
from laborlens.operators.dedupe import keep_first
from laborlens.sinks.landing import land_envelopes
from laborlens.sinks.snapshots import SnapshotTable
from laborlens.sources import bronze
from laborlens.streaming import incremental as Z


def test_readers_keep_the_old_version_until_the_commit(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    table.overwrite(spark.range(3), "v1")
    old = table.read()
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.overwrite(broken, "v2")
    assert table.versions() == ["v1"] and table.read().count() == 3
    table.overwrite(spark.range(7), "v2")
    assert (table.read().count(), table.read("v1").count(), old.count()) == (7, 3, 3)
    table.overwrite(spark.range(7), "v2")  # the same run again
    assert table.versions() == ["v1", "v2"] and table.read().count() == 7
    assert table.vacuum(keep=1) == ["data-v1"] and table.read().count() == 7


def test_columns_are_merged_over_versions(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    table.append(spark.createDataFrame([(1, "a")], "id long, x string"), "v1")
    table.append(spark.createDataFrame([(2, 5.0)], "id long, y double"), "v2")
    assert table.read().columns == ["id", "x", "y"]
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, "a", None), (2, None, 5.0)]
    assert table.read("v1").columns == ["id", "x"]


def test_a_landed_run_replaces_itself_only(spark, tmp_path):
    root = str(tmp_path / "bronze")
    rows = spark.createDataFrame([(f"t{i}", f"u{i}") for i in range(5)], "title string, url string")
    land = lambda df, run: land_envelopes(df, root, {"source": F.lit("news")}, "url", "records", "record_count", run,
                                          "2024-01-31T06:00:00Z")
    land(rows, "run1")
    land(rows.limit(2), "run2")
    land(rows, "run1")
    back = bronze.load_source(spark, root, "news", schemas.NEWS)
    assert {r.landed_run: r["count"] for r in back.groupBy("landed_run").count().collect()} == {"run1": 5, "run2": 2}


def test_log_structured_history(spark, tmp_path):
    """Many small changes: the merged state is that of all sums, folders stay few, writing follows the change."""
    r = random.Random(2)
    merge, table = Z.merged_history(points=4), SnapshotTable(spark, str(tmp_path / "state"))
    seen = {}
    for batch in range(11):
        rows = [(r.choice("abc"), "x", f"2024-01-{r.randint(1, 12):02d}", r.randint(0, 5), r.randint(0, 5)) for _ in range(8)]
        for c, city, day, h, lay in rows:
            a, b = seen.get((c, city, day), (0, 0))
            seen[c, city, day] = (a + h, b + lay)
        df = spark.createDataFrame(rows, "company string, city string, date string, hiring long, layoffs long")
        for _ in range(1 + (batch == 5)):  # one batch is repeated
            table.upsert(df, f"b{batch:03d}", merge, fanout=3)
        assert len(table.folders()) <= 2 * 3
        last = table.folders()
        assert all(f["level"] <= 2 for f in last)
    want = []
    for c in "abc":
        days = sorted((d for k, _, d in seen if k == c), reverse=True)[:4]
        want += [(c, "x", d, *seen[c, "x", d]) for d in days]
    got = merge(table.read()).select("company", "city", "date", "hiring", "layoffs").collect()
    assert sorted(tuple(x) for x in got) == sorted(want)


def _silver(spark, root, batches):
    """A stream of one landed file per batch, read in the order given."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(f"t{n}", "", "Acme", "Pune", None, "layoff", p, u, "f", "api", s)
                                    for n, (u, p, s) in enumerate(rows)], schemas.NEWS)
        land_envelopes(df.coalesce(1), root, {"source": F.lit("news")}, "url", "records", "record_count", f"run{i}",
                       "2024-01-31T06:00:00Z")
        for d, _, names in os.walk(f"{root}/source=news"):
            for name in names:
                if f"run=run{i}" in d:
                    os.utime(f"{d}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    return Z.silver_news_stream(Z.news_stream(spark, root, max_files=1), D.CANONICAL_COMPANIES, D.CITY_ALIASES)


COPIES = [[("u1", "2024-01-05T10:00:00Z", "2024-01-05T12:00:00Z"), ("u2", "2024-01-06T10:00:00Z", "2024-01-07T00:00:00Z")],
          [("u1", "2024-01-05T10:00:00Z", "2024-01-05T11:00:00Z"), ("u2", "2024-01-06T10:00:00Z", "2024-01-08T00:00:00Z")],
          [("u1", "2024-01-05T10:00:00Z", "2024-01-05T13:00:00Z"), ("u3", "2024-01-07T10:00:00Z", "2024-01-09T00:00:00Z")]]


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_earliest_copy_whatever_the_order_of_files(spark, tmp_path, order):
    silver = _silver(spark, str(tmp_path / "in"), [COPIES[i] for i in order])
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    Z.run_earliest(silver, out, ck)
    got = {r.url_key: r.scraped_at for r in Z.read_earliest(spark, out, silver.schema).collect()}
    assert got == {"u1": "2024-01-05T11:00:00Z", "u2": "2024-01-07T00:00:00Z", "u3": "2024-01-09T00:00:00Z"}
    assert Z.read_late(spark, out, silver.schema).count() == 0
    Z.run_earliest(silver, out, ck)  # nothing new has landed
    assert Z.read_earliest(spark, out, silver.schema).count() == 3


def test_state_expires_and_late_rows_are_kept_aside(spark, tmp_path):
    batches = [[("u1", "2024-01-05T10:00:00Z", "2024-01-05T12:00:00Z")], [("u2", "2024-06-01T10:00:00Z", "2024-06-01T12:00:00Z")],
               [("u3", "2024-06-02T10:00:00Z", "2024-06-02T12:00:00Z")],  # the clock is in June: January is late
               [("u1", "2024-01-05T10:00:00Z", "2024-01-05T11:00:00Z"), ("u2", "2024-06-01T10:00:00Z", "2024-06-01T11:00:00Z")]]
    silver = _silver(spark, str(tmp_path / "in"), batches)
    out = str(tmp_path / "out")
    Z.run_earliest(silver, out, str(tmp_path / "ck"), keep_days=30, grace_days=365)
    late = Z.read_late(spark, out, silver.schema).collect()
    assert [(r.url_key, r.scraped_at) for r in late] == [("u1", "2024-01-05T11:00:00Z")]
    got = {r.url_key: r.scraped_at for r in Z.read_earliest(spark, out, silver.schema).collect()}
    assert got == {"u1": "2024-01-05T12:00:00Z", "u2": "2024-06-01T11:00:00Z", "u3": "2024-06-02T12:00:00Z"}


def test_late_rows_of_any_age_are_kept_aside(spark, tmp_path):
    """the state is merged table folders, so no row is beyond what the side table takes; a repeated batch changes nothing."""
    batches = [[("u1", "2024-06-01T10:00:00Z", "2024-06-01T12:00:00Z")], [("u1", "2021-01-05T10:00:00Z", "2021-01-05T11:00:00Z"),
                                                                           ("u2", "2024-05-20T10:00:00Z", "2024-05-20T11:00:00Z")]]
    silver = _silver(spark, str(tmp_path / "in"), batches)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    Z.run_earliest(silver, out, ck)
    look = lambda read: sorted((r.url_key, r.scraped_at) for r in read(spark, out, silver.schema).collect())
    want = [("u1", "2024-06-01T12:00:00Z"), ("u2", "2024-05-20T11:00:00Z")], [("u1", "2021-01-05T11:00:00Z")]
    assert (look(Z.read_earliest), look(Z.read_late)) == want
    newest = max(os.listdir(f"{ck}/commits"), key=lambda n: int(n) if n.isdigit() else -1)
    for name in (newest, f".{newest}.crc"):
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    Z.run_earliest(silver, out, ck)  # the last batch runs again
    assert (look(Z.read_earliest), look(Z.read_late)) == want


def test_earliest_news_takes_rows_of_every_date(spark, tmp_path, monkeypatch):
    """rows that land months behind the newest ones are part of the result, in every order of the micro-batches."""
    from laborlens.catalog import streams
    days = [f"2024-{m:02d}-{d:02d}T10:00:00Z" for m in (6, 1, 3, 11) for d in (5, 6)]
    batches = [[(f"u{i}", day, day), (f"u{i}", day, day.replace("T10", "T09"))] for i, day in enumerate(days)]
    monkeypatch.setattr(streams, "_silver_stream", lambda s, d: _silver(s, str(tmp_path / "in"), batches))
    got = {r.url_key: r.scraped_at for r in streams.q_stream_earliest(spark, "none").collect()}
    assert got == {f"u{i}": day.replace("T10", "T09") for i, day in enumerate(days)}


def test_windows_equal_the_batch_counts_and_repeat_safely(spark, tmp_path):
    silver = _silver(spark, str(tmp_path / "in"), COPIES)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    assert Z.windowed_signals(silver, out, ck) == 0
    rows = lambda: sorted((str(r.window_start)[:10], r.articles) for r in Z.read_windows(spark, out).collect())
    want = [("2024-01-05", 3), ("2024-01-06", 2), ("2024-01-07", 1)]
    assert rows() == want
    newest = max(os.listdir(f"{ck}/commits"), key=lambda n: int(n) if n.isdigit() else -1)
    for name in (newest, f".{newest}.crc"):
        if os.path.exists(f"{ck}/commits/{name}"):
            os.remove(f"{ck}/commits/{name}")
    Z.windowed_signals(silver, out, ck)  # the last batch runs again
    assert rows() == want


def test_late_rows_of_windows_are_counted(spark, tmp_path):
    batches = [[("u2", "2024-06-01T10:00:00Z", "s")], [("u3", "2024-06-02T10:00:00Z", "s")], [("u1", "2024-01-05T10:00:00Z", "s")]]
    with pytest.warns(UserWarning, match="1 rows"):
        assert Z.windowed_signals(_silver(spark, str(tmp_path / "in"), batches), str(tmp_path / "out"), str(tmp_path / "ck"),
                                  delay="30 days") == 1


def test_batch_and_stream_keep_the_same_row(spark, tmp_path):
    rows = [("t", u, "2024-01-05T10:00:00Z", s) for u, s in itertools.product("ab", ("3", None, "1"))]
    df = spark.createDataFrame(rows, "title string, url_key string, published_ts string, scraped_at string")
    assert {r.url_key: r.scraped_at for r in keep_first(df, ["url_key"], Z.U2_ORDER).collect()} == {"a": None, "b": None}
