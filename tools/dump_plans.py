"""Write the physical plan tree of every registered query to PLANS.md.

Usage: python tools/dump_plans.py [sf_dir]   (default /root/testdata/sf0.01)
Model queries fit their models while the DataFrame is built; their plans
show the scoring step only.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from forecastry.plans.queries import QUERIES  # noqa: E402
from forecastry.session import get_session  # noqa: E402

HEADER = """# Physical plans

Generated by `tools/dump_plans.py` from `explain("formatted")` on sf0.01,
`local[8]`, 8 shuffle partitions (tree part only; AQE may still coalesce
partitions or switch join strategies at run time). Scans of the scratch
tables written by `session.materialize` show as `Scan parquet` over the
checkpoint folder.
"""


def tree(df) -> str:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    lines = []
    for line in text.splitlines():
        if line.startswith("== Physical Plan =="):
            continue
        if not line.strip():
            break
        lines.append(line)
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]", shuffle_partitions=8)
    out = [HEADER]
    for name, fn in QUERIES.items():
        out.append(f"## {name}\n\n```\n{tree(fn(spark, sf))}\n```\n")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
