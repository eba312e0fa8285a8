"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the tables, default /root/testdata/sf0.1
BENCH_CPUS     local cores, default 8
BENCH_QUERIES  comma-separated names, default all headline queries
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from checks import queries as q
from checks.standins import Tables
from shelfwise.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "interactions", "reorder_stats", "inventory_avail", "txn_counts", "matrix_cells", "bm25",
    "dense_index", "due_items", "score_norm", "backfill", "recs_in_stock", "topk_items",
    "knn_scope_region", "similar_customers_rows", "sink_recs", "export_recs_csv", "run_ledger",
    "log_errors",
]
# The two jobs with their full default parameters.
JOBS = {
    "order_recommendations_full": lambda s, d: q.order_job(Tables(s, d), q.ORDERS),
    "similar_customers_full": lambda s, d: q.customer_job(Tables(s, d), q.SIMILAR).neighbors,
}


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "20g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: q.QUERIES[name] for name in HEADLINE} | JOBS
    wanted = os.environ.get("BENCH_QUERIES")
    if wanted:
        runs = {name: runs.get(name) or q.QUERIES[name] for name in wanted.split(",")}
    q.QUERIES["matrix_cells"](spark, FOLDER).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run(spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", FOLDER)
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1)) if found else None,
    }))


if __name__ == "__main__":
    main()
