"""bench.py prints one JSON line with the contract fields."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_TINY


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_TINY, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="annual_stats,roc")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert set(rec["queries"]) == {"annual_stats", "roc"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3)
