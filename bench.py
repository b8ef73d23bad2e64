"""Benchmark the headline jobs.

Runs each job at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and forces full execution with the no-op sink (nothing is
collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, _HERE)
# Python workers import the package too, whatever the working directory
os.environ["PYTHONPATH"] = os.pathsep.join([_HERE, *filter(None, [os.environ.get("PYTHONPATH")])])

from keelson.plans.registry import JOBS  # noqa: E402
from keelson.session import build_session  # noqa: E402

HEADLINE = [
    "ready_tasks", "next_tasks", "blocked_tasks", "progress_report", "cycle_members", "critical_path",
    "pagerank", "triage", "blockers_to_clear", "parallel_tracks", "project_health", "current_task", "worktree_summary", "branch_diff_stats", "pr_issues",
    "check_failure_rate", "reservation_conflicts", "feedback_items", "normalize_tasks", "validate_tasks",
    "stream_current_status",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="keelson-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up (not timed): JVM start, Python workers, first file listing
    from keelson.sources.bind import RAW_TABLES
    for t in RAW_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        t0 = time.time()
        JOBS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
