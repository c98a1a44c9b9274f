"""Times the headline queries and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores),
``BENCH_RUNS`` (runs; their median counts, so the first of three warms up).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from shelfrank import build_session  # noqa: E402
from shelfrank.plans.queries import queries  # noqa: E402

HEADLINE = [
    "search_hits",
    "session_lists",
    "train_contexts",
    "validation_contexts",
    "graded_judgments",
    "order_lists",
    "order_graded_judgments",
    "dbn_judgments",
    "catalog_docs",
    "match_all_terms",
    "bm25_documents",
    "first_pass_topk",
    "rescored_topk",
    "feature_log_normalised",
    "err_documents",
    "mean_percentile_rank",
    "lambdamart_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "shelfrank-bench",
        master=f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    times = {}
    for name in names:
        samples = []
        for _ in range(runs):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - start)
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
