"""Benchmark the registered queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default all), BENCH_JOBS (1 = also time the batch
jobs end to end under "jobs"; not part of "value").  Each query is built and
then run to completion into Spark's ``noop`` sink (full execution, nothing
collected).
Every query first runs once, untimed, on the smallest data set (JIT warm-up).
A query that fails is named under "errors" with its reason, and the others are
timed.  The tuned forest (100 trees of depth 12) is timed by itself on the middle
data set, under "tuned_forest": on the large one it alone would take minutes.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forecastry.plans.queries import QUERIES  # noqa: E402
from forecastry.session import get_session  # noqa: E402


TUNED, MIDDLE_DIR = "tuned_forest_check", "/root/testdata/sf0.01"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = wanted or [q for q in QUERIES if q != TUNED]
    spark = get_session(
        app="forecastry-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        extra_conf={"spark.driver.memory": "16g"},
    )
    # Warm-up, not timed: every query once on the smallest data set, so JIT
    # compilation of Spark's own code paths is not billed to the timed runs.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    errors: dict[str, str] = {}

    def attempt(name: str, folder: str) -> float | None:
        t0 = time.perf_counter()
        try:
            run(QUERIES[name](spark, folder))
        except Exception as exc:  # the other queries are still timed
            errors[name] = f"{type(exc).__name__}: {str(exc).splitlines()[0][:200]}" if str(exc) else type(exc).__name__
            return None
        return round(time.perf_counter() - t0, 3)

    for name in names:
        attempt(name, warm_dir)
    errors.clear()  # of the warm-up
    times: dict[str, float] = {}
    for name in names:
        took = attempt(name, sf_dir)
        if took is not None:
            times[name] = took
    m = re.search(r"sf([0-9.]+)", sf_dir)
    record = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "warmup": f"every query once on {warm_dir}",
    }
    if not wanted and os.path.isdir(MIDDLE_DIR):
        record["tuned_forest"] = {"sec": attempt(TUNED, MIDDLE_DIR), "sf_dir": MIDDLE_DIR}
    if errors:
        record["errors"] = errors
    if os.environ.get("BENCH_JOBS", "1") == "1":
        try:
            record["jobs"] = time_jobs(spark, sf_dir)
        except Exception as exc:  # the query timings above still stand
            record["jobs"] = {"error": type(exc).__name__}
    print(json.dumps(record))
    spark.stop()


def time_jobs(spark, sf_dir: str) -> dict[str, float]:
    """The batch jobs end to end (not part of ``value``): a raw text CSV of the
    holed panel is written first (untimed), then ingest -> explore -> features
    -> train (light forest) -> status, each reading the zone the previous wrote."""
    from pyspark.sql import functions as F

    from forecastry.plans import jobs
    from forecastry.schema import RAW_COLUMNS
    from forecastry.session import scratch_path
    from forecastry.sources import tables, write_csv

    root = scratch_path(spark, "bench-jobs")
    z = {k: os.path.join(root, k) for k in ("raw", "processed", "training", "eda", "features", "pred", "models")}
    write_csv(tables.holes(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS]), z["raw"])
    steps = {
        "ingest": lambda: jobs.ingest(spark, z["raw"], z["processed"], z["training"]),
        "explore": lambda: jobs.explore(spark, z["processed"], z["eda"]),
        "features": lambda: jobs.build_features(spark, z["processed"], z["features"]),
        "train_light": lambda: jobs.train(spark, z["features"], z["pred"], z["models"], forest="light"),
        "status": lambda: [df.count() for df in jobs.status_report(
            tables.run_log(spark, sf_dir), tables.jobs(spark, sf_dir), tables.artefacts(spark, sf_dir)).values()],
    }
    out = {}
    for name, fn in steps.items():
        t0 = time.perf_counter()
        fn()
        out[name] = round(time.perf_counter() - t0, 3)
    return out


if __name__ == "__main__":
    main()
