"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

from conftest import SMOKE

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMOKE, BENCH_WARMUP_DIR=SMOKE, BENCH_CPUS="2",
               BENCH_QUERIES="monthly_sales,latest_run", BENCH_JOBS="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"monthly_sales", "latest_run"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3) or abs(rec["value"] - sum(rec["queries"].values())) < 1e-2
