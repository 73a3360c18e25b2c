"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (all rows computed, nothing
collected). One untimed warm-up pass runs first (a warm session, as in the baseline's reference point).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapflow.plans.queries import QUERIES  # noqa: E402
from snapflow.session import get_spark  # noqa: E402

HEADLINE = [
    "trends", "daily_rank", "moving_avg", "history_replay", "history_step", "dimension", "metrics",
    "stage_repos", "stage_packages", "latest_package", "check_suite", "land_valid", "daily_trends",
    "trends_look_back", "daily_rank_window", "daily_rank_buckets", "history_upsert", "history_three_days", "schema_sync",
    "stream_latest_repo", "daily_run", "daily_run_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    def run(n: str) -> None:
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for n in names:                       # warm-up pass (JIT, file metadata), untimed
        try:
            run(n)
        except Exception as e:  # noqa: BLE001 - reported below, the timed pass decides
            print(f"warm-up {n} failed: {e}", file=sys.stderr)
    times = {}
    for n in names:
        t0 = time.perf_counter()
        try:
            run(n)
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - a failed query is reported, not hidden
            print(f"{n} failed: {e}", file=sys.stderr)
            times[n] = None
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    done = [t for t in times.values() if t is not None]
    print(json.dumps({"metric": "headline_total", "value": round(sum(done), 3), "unit": "sec",
                      "queries": times, "failed": [n for n, t in times.items() if t is None],
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
