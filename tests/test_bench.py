"""bench.py prints one JSON line with the driver's fields."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_RUNS="1", BENCH_QUERIES="monthly_revenue,mom_growth")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"monthly_revenue", "mom_growth"}
    assert d["value"] == pytest.approx(sum(d["queries"].values()), abs=0.01) and "failed" not in d
