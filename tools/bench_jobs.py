"""Time the batch jobs end to end on a raw CSV built from the supplied tables.

Usage: python tools/bench_jobs.py [sf_dir]     (default /root/testdata/sf0.1)
The raw zone (text CSV of the holed panel) is written under the session's
checkpoint folder first (untimed); every job then reads and writes its own
zone there.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from forecastry.plans import jobs  # noqa: E402
from forecastry.schema import RAW_COLUMNS  # noqa: E402
from forecastry.session import get_session, scratch_path  # noqa: E402
from forecastry.sources import tables, write_csv  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session(master="local[8]", shuffle_partitions=8, extra_conf={"spark.driver.memory": "16g"})
    root = scratch_path(spark, "jobs")
    z = {k: os.path.join(root, k) for k in ("raw", "processed", "training", "eda", "features", "predictions", "models")}
    write_csv(tables.holes(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS]), z["raw"])

    times, report = {}, {}

    def step(name, fn):
        t0 = time.perf_counter()
        report[name] = fn()
        times[name] = round(time.perf_counter() - t0, 3)

    step("ingest", lambda: jobs.ingest(spark, z["raw"], z["processed"], z["training"]))
    step("explore", lambda: jobs.explore(spark, z["processed"], z["eda"]))
    step("features", lambda: jobs.build_features(spark, z["processed"], z["features"]))
    step("train_light", lambda: jobs.train(spark, z["features"], z["predictions"], z["models"], forest="light"))
    step("status", lambda: {k: v.count() for k, v in jobs.status_report(
        tables.run_log(spark, sf), tables.jobs(spark, sf), tables.artefacts(spark, sf)).items()})
    rmse = {k: round(v, 4) for k, v in report["train_light"].items() if k != "sample_predictions"}
    print(json.dumps({"sf_dir": sf, "job_sec": times, "total_sec": round(sum(times.values()), 3),
                      "rows": report["ingest"]["n_rows"], "rmse": rmse}))


if __name__ == "__main__":
    main()
