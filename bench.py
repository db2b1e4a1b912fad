"""Time the registered queries and print one JSON line.

Each query runs once to warm up and three times for the record; its figure is the
median, from building the plan to having every row computed. Queries that write files
before they read (ingest, bundle, streams) run once more after their warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import files, streams  # noqa: E402
from ledgerlens.plans.queries import catalogue  # noqa: E402
from ledgerlens.session import local_session  # noqa: E402


def run_once(query, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = set(filter(None, os.environ.get("BENCH_QUERIES", "").split(",")))
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    writing = {*files.QUERIES, *streams.QUERIES}
    seconds = {}
    for name, query in catalogue().items():
        if only and name not in only:
            continue
        run_once(query, spark, sf_dir)
        runs = 1 if name in writing else 3
        seconds[name] = round(statistics.median(run_once(query, spark, sf_dir) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds, sum of the medians of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
