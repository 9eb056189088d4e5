"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_RUNS (timed runs per query after one warm-up, default 5),
BENCH_QUERIES (comma-separated subset, default all).  Each run executes the
whole plan into Spark's ``noop`` sink, so nothing is collected; the reported
figure per query is the median run.  Progress goes to stderr.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shoplens.plans import inspect as plan_facts  # noqa: E402
from shoplens.plans.registry import HEADLINE, QUERIES  # noqa: E402
from shoplens.session import build_session  # noqa: E402


def _sf_of(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    subset = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = subset or list(QUERIES)

    spark = build_session(
        f"local[{cpus}]",
        app_name="shoplens-bench",
        shuffle_partitions=cpus,
        extra={"spark.driver.memory": "8g", "spark.sql.maxMetadataStringLength": "10000"},
    )
    sc = spark.sparkContext
    tracker = sc.statusTracker()

    timings: dict[str, float] = {}
    jobs: dict[str, int] = {}
    shuffles: dict[str, int] = {}
    scans: dict[str, int] = {}
    failed: dict[str, str] = {}
    for name in names:
        build = QUERIES[name]
        try:
            probe = build(spark, sf_dir)
            shuffles[name] = plan_facts.exchanges(probe)
            # identical scans (a reused subquery printed at each use) count once
            scans[name] = len({tuple(sorted(x.items())) for x in plan_facts.scans(probe)})
            samples = []
            for i in range(runs + 1):
                group = f"bench-{name}-{i}"
                sc.setJobGroup(group, name)
                t0 = time.perf_counter()
                build(spark, sf_dir).write.format("noop").mode("overwrite").save()
                elapsed = time.perf_counter() - t0
                if i == 0:
                    jobs[name] = len(tracker.getJobIdsForGroup(group))
                else:
                    samples.append(elapsed)
        except Exception as exc:  # record and go on: one failure must not hide the rest
            failed[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
            print(f"{name:30s} FAILED {failed[name]}", file=sys.stderr, flush=True)
            continue
        timings[name] = round(statistics.median(samples), 4)
        print(
            f"{name:30s} {timings[name]:.3f}s jobs={jobs[name]} "
            f"shuffles={shuffles[name]} scans={scans[name]}",
            file=sys.stderr,
            flush=True,
        )
    sc.setLocalProperty("spark.jobGroup.id", None)

    headline = [q for q in HEADLINE if q in timings]
    result = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "headline_sec": round(sum(timings[q] for q in headline), 4),
        "failed": failed,
        "spark_jobs": jobs,
        "shuffles": shuffles,
        "parquet_scans": scans,
        "sf": _sf_of(sf_dir),
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
