"""Time every registered query; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default all), BENCH_EVENT_LOG_DIR
(optional: write Spark's event log there for stage and task times).  Each query runs to
completion through a no-op sink (the whole plan executes, nothing is
collected).  Fitted models and the cleaned table are shared between queries
as in a real application; they are built first and timed under ``build:``
names.  Each figure goes to stderr as it comes, and a query that runs longer
than BENCH_LIMIT seconds (default 300) is cancelled and listed as failed, so
that no query takes the others' figures with it.  BENCH_COLD=1 drops all that is shared before each query instead, so
every query pays for what it needs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import threading
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def timed(spark, name: str, run, limit: float) -> float:
    """Seconds of ``run()``; its jobs are cancelled at the limit, which makes it raise."""
    timer = threading.Timer(limit, spark.sparkContext.cancelAllJobs)
    timer.start()
    start = time.perf_counter()
    try:
        run()
        return round(time.perf_counter() - start, 3)
    finally:
        timer.cancel()
        print(f"{name} {time.perf_counter() - start:.3f}", file=sys.stderr, flush=True)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from riskspark.plans.catalog import QUERIES
    from riskspark.session import build_session

    from riskspark.plans import cache, catalog

    conf = {"spark.driver.memory": "20g",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-")}
    cold = os.environ.get("BENCH_COLD") == "1"
    limit = float(os.environ.get("BENCH_LIMIT", "300"))
    event_log = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_log:
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = build_session(f"local[{cpus}]", app_name="riskspark-bench",
                          shuffle_partitions=max(8, 2 * cpus), conf=conf)
    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    builds = {} if cold or wanted else {
        "build:cleaned_table": catalog.cleaned_incidents, "build:feature_stages": catalog.feature_model,
        "build:forest_fit": catalog.resolution_model, "build:model_export": catalog.exported_model,
        "build:kmeans_fit": catalog.segment_vectors}
    for name, build in builds.items():
        try:
            timings[name] = timed(spark, name, lambda: build(spark, sf_dir), limit)
        except Exception as exc:  # the queries that need it will say so too
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    for name, query in QUERIES.items():
        if wanted and name not in wanted:
            continue
        if cold:
            cache.forget(spark)
        try:
            timings[name] = timed(spark, name, lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save(), limit)
        except Exception as exc:  # keep benchmarking the rest
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
