"""End-to-end batch run over landed bronze, twice (history and is_new)."""

from pyspark.sql import functions as F

from laborlens import schemas
from laborlens.plans.batch import run
from laborlens.sinks.landing import land_envelopes

JOBS = [("Data Engineer", "Infosys Ltd", "Bengaluru", "bangalore", "", "", "2024-01-31", "j1", "board_a", "2024-01-31T01:00:00Z"),
        ("Analyst", "Wipro", "Pune", "pune", "", "", "2024-01-31", "j2", "board_a", "2024-01-31T01:00:00Z"),
        ("Analyst", "Wipro", "Pune", "pune", "", "", "2024-01-31", "j3", "board_a", "2024-01-31T02:00:00Z")]
NEWS = [("Wipro announces mass hiring", "", "Wipro", "Pune", "1,500", "hiring", "2024-01-30T10:00:00Z", "n1", "f", "api",
         "2024-01-30T11:00:00Z"),
        ("Zeta lays off 200 employees", "", "Zeta Labs", "Mumbai", "200", "layoff", "2024-01-29T10:00:00Z", "n2", "f", "api",
         "2024-01-29T11:00:00Z")]
REG = [("Infosys Limited", None, "L85110KA", "Active", None, None, "Karnataka", "Bengaluru", None, None, "", "", "",
        "Technology", "seed", "2024-01-01T00:00:00Z")]


def land(spark, root, run_ts, batch_ts):
    land_envelopes(spark.createDataFrame(JOBS, schemas.JOB), root, {"source": F.col("source"), "city": F.col("city_key")},
                   "job_url", "jobs", "job_count", run_ts, batch_ts)
    land_envelopes(spark.createDataFrame(NEWS, schemas.NEWS), root, {"source": F.lit("news")}, "url", "records",
                   "record_count", run_ts, batch_ts)
    land_envelopes(spark.createDataFrame(REG, schemas.REGISTER), root, {"source": F.lit("register")}, "name",
                   "records", "record_count", run_ts, batch_ts)


def test_two_runs(spark, tmp_path):
    raw, hist = str(tmp_path / "raw"), str(tmp_path / "history")
    land(spark, raw, "r1", "2024-01-31T03:00:00Z")
    out1 = run(spark, raw, str(tmp_path / "out1"), "2024-01-31 06:00:00", "r1", history_root=hist)
    comp = {(r.name, r.city): r for r in out1["companies_all"].collect()}
    # "Infosys Limited" scores 63.6 against "Infosys" (< 72): the register row stays its own company
    assert set(comp) == {("Infosys", "Bengaluru"), ("Infosys Limited", "Bengaluru"), ("Wipro", "Pune"),
                         ("Zeta Labs", "Mumbai")}
    assert comp[("Wipro", "Pune")].hiring == 1 and comp[("Wipro", "Pune")].status == "hiring"
    assert comp[("Zeta Labs", "Mumbai")].status == "layoff" and comp[("Zeta Labs", "Mumbai")].layoffs == 200
    assert comp[("Infosys Limited", "Bengaluru")].sector == "Technology"
    assert comp[("Infosys", "Bengaluru")].sector == "IT Services"
    assert all(r.is_new for r in comp.values())
    meta = out1["meta"].first()
    assert (meta.total_companies, meta.new_companies, meta.total_districts) == (4, 4, 3)
    # second run a day later: same bronze, history grows, nothing is new
    out2 = run(spark, raw, str(tmp_path / "out2"), "2024-02-01 06:00:00", "r2", history_root=hist)
    comp2 = {(r.name, r.city): r for r in out2["companies_all"].collect()}
    assert not any(r.is_new for r in comp2.values())
    assert {len(r.trend) for r in comp2.values()} == {2}
    docs = spark.read.json(str(tmp_path / "out2" / "city_summary" / "districts")).count()
    assert docs == 3
    # the same run again (a retry): same companies, same flags, same history
    rows = lambda df: sorted(map(str, df.collect()))
    before = rows(out2["companies_all"]), rows(out2["history"])
    again = run(spark, raw, str(tmp_path / "out3"), "2024-02-01 06:00:00", "r2", history_root=hist)
    assert (rows(again["companies_all"]), rows(again["history"])) == before
    again = run(spark, raw, str(tmp_path / "out3"), "2024-02-01 06:00:00", "r2", history_root=hist)
    assert (rows(again["companies_all"]), rows(again["history"])) == before
