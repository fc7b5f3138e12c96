"""Time the reference's job shape against the one-pass operators.

naive:    one Spark job per null count, per statistic and per correlation
          (each rescans the input), the way the reference printed them.
one-pass: ``profile.profile`` - every statistic in one aggregate.
Also: three separate EDA group-bys vs one cube pass.

Usage: python tools/compare_naive.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from forecastry.operators import profile, summaries  # noqa: E402
from forecastry.session import get_session, materialize  # noqa: E402
from forecastry.sources import tables  # noqa: E402


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def naive_profile(df) -> dict:
    """One Spark job per statistic."""
    out = {c: df.filter(F.col(c).isNull()).count() for c in df.columns}
    out["mean"] = df.agg(F.avg("sales")).first()[0]
    for a, b in (("store", "item"), ("store", "sales"), ("item", "sales")):
        out[f"corr_{a}_{b}"] = df.agg(profile.corr_column(a, b, True)).first()[0]
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    holes = materialize(tables.holes(spark, sf), "naive-holes")
    holes.count()

    def naive_describe():
        naive_profile(holes)
        holes.describe(["sales", "store", "item"]).collect()

    def one_pass():
        profile.profile(holes).collect()

    def three_groupbys():
        for out in (summaries.monthly_sales(holes), summaries.store_avg(holes), summaries.item_sales(holes)):
            out.collect()

    def cube():
        c = summaries.sales_cube(holes).persist()
        for out in summaries.summaries_from_cube(c).values():
            out.collect()
        c.unpersist()

    res = {}
    for name, fn in (("profile_naive", naive_describe), ("profile_one_pass", one_pass),
                     ("summaries_three_scans", three_groupbys), ("summaries_one_cube", cube)):
        fn()  # warm
        res[name] = min(timed(fn) for _ in range(3))
    print(json.dumps({"sf_dir": sf, "best_of_3_sec": res}))


if __name__ == "__main__":
    main()
