"""Time the headline queries on one machine and print one JSON line.

The fixture tables are written once as Parquet ("setup"), as a workflow store would hold them.
Each query is then run to completion into a sink that discards rows, once to warm up and three
times timed; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from galleyproof.session import build_session
from workload import basics, changing, functions, landing, linking, reporting  # noqa: F401
from workload.fixtures import Fixtures
from workload.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = 3
TABLES = [
    "papers", "iterations", "reports", "replicators", "form_arrivals", "raw_arrivals", "uploads",
    "packages", "articles", "datasets", "manifest", "local_files", "remote_files",
]
HEADLINE = [
    "days_in_status", "status_board", "global_report", "time_in_status", "workload",
    "paper_report", "timeline", "hours_summary", "quarterly_budget", "assignments", "history",
    "effort", "turnaround", "overdue", "arrivals_check", "previous_candidates", "backlog",
    "latest_iteration", "update_from_latest", "carry_replicators", "reports_to_process", "new_rows",
    "clean_arrivals", "append_new", "merge_reports", "transition", "accept_rounds", "revise_rounds",
    "assign_rounds", "mark_arrived", "publish", "validate", "repair", "duplicate_keys", "restore",
    "reconcile", "link_articles", "workload_items", "latest_long", "two_slots", "requests_long",
    "purge", "restore_log", "metrics", "transition_conflicts", "ingest_forms",
]


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    started = time.perf_counter()
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        tables = Fixtures(spark, SF_DIR).save(folder, TABLES, int(CPUS))
        setup = time.perf_counter() - started
        times = {}
        for name in HEADLINE:
            runs = []
            for _ in range(RUNS + 1):
                begun = time.perf_counter()
                QUERIES[name](tables).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - begun)
            times[name] = round(statistics.median(runs[1:]), 4)
    total = round(sum(times.values()), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "setup_sec": round(setup, 2),
        "cpus": int(CPUS), "spark": spark.version, "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
