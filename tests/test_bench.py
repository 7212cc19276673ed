"""bench.py prints exactly one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_ONLY="count_orders,customer_tiles",
               BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["metric"] == "total_query_seconds" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"count_orders", "customer_tiles"} and "failures" not in d
    assert d["value"] == round(sum(d["queries"].values()), 3)
