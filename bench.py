"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the number of local cores. Each query runs once to
warm up and then counts with its best of BENCH_RUNS; the streaming replays, which write
tables, run once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tideline.plans.queries import QUERIES  # noqa: E402
from tideline.session import build_session  # noqa: E402

# One directory for each event minute: tens of thousands on one machine, so by name only.
BY_NAME = {"dedupe_job_minute", "stream_minute_layout"}
ONCE = {"dedupe_job", "dedupe_job_minute", "reconcile_job", "native_final_sessions"}


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or [name for name in QUERIES if name not in BY_NAME]
    spark = build_session("tideline-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        if name in ONCE or name.startswith("stream_"):
            times[name] = round(seconds(spark, name, sf_dir), 3)
            continue
        seconds(spark, name, sf_dir)
        times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    found = re.search(r"sf([\d.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(found.group(1)) if found else None, "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
