"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Every query runs once to warm up and is then timed BENCH_RUNS times (default 3); the median
counts. A run builds the plan and writes all rows to the no-op sink, so nothing is pruned
away. Inputs derived from the test tables are stored before the clock starts.
"""

from __future__ import annotations

import json
import os
import pathlib
import re
import statistics
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from martloom.plans import ALL_QUERIES
from martloom.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = (
    "classify_pages",
    "classify_pages_lemmas",
    "keyword_top70",
    "theme_matches",
    "label_prompts",
    "metadata_resolve_all",
    "metadata_plan_policy",
    "metadata_ddl",
    "recache_due",
    "view_gate",
    "forecast_params",
    "future_spine",
    "forecast_trend_dow",
    "plan_fact_mix",
    "backtest_error",
    "forecast_additive",
    "columnar_json_read",
)


def run(spark, name: str) -> float:
    start = time.perf_counter()
    ALL_QUERIES[name][0](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = local_session(CPUS, "16g")
    seconds = {}
    for name in names:
        run(spark, name)
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
    found = re.search(r"sf([0-9.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()
