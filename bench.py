"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected). Small warm-up queries start the JVM and the Python/Arrow
workers first and are not timed. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from laborlens.catalog.registry import load_all  # noqa: E402
from laborlens.session import get_spark  # noqa: E402

HEADLINE = [
    "gold_city_summary",      # flagship: silver x3 -> company -> city rollup
    "gold_company",           # full-outer company table with headlines
    "silver_jobs",            # 4-way join, similarity match, dedupe
    "silver_news",            # parse, score, window filter, URL dedupe
    "silver_register",        # raw maps, union, match, dedupe
    "company_trend",          # history update + trend
    "payroll_by_city",        # html tables + split
    "signal_classify",        # text classification over three tables
    "document_extract",       # regex extraction over documents
    "page_job_cards",         # html card extraction
    "companies_all",          # served companies with trend and new flag
    "batch_run_companies",    # landing -> bronze -> silver -> gold -> documents
    "stream_history_upsert",  # streaming upsert into the versioned history
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(cpus))
    reg = load_all()
    # warm-up (not timed): JVM, codegen and the Python/Arrow workers
    reg["sector_of_companies"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    reg["name_title_case"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    from laborlens.functions.similarity import with_company_norm
    from laborlens.sources.tables import read
    with_company_norm(read(spark, sf_dir, "nation"), "n_name", "x").write.format("noop").mode("overwrite").save()
    times, errors = {}, {}
    for name in HEADLINE:
        t0 = time.time()
        try:
            reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # record and keep going: one failure must not hide the rest
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    result = {"metric": "headline_queries_total", "value": round(sum(t for t in times.values() if t), 3),
              "unit": "sec", "queries": times, "sf": sf}
    if errors:
        result["errors"] = errors
    print(json.dumps(result))


if __name__ == "__main__":
    main()
