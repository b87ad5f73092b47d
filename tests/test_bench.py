"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "q2_street_parts"],
        capture_output=True, text=True, timeout=600, env=env, cwd=ROOT,
    )
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert result["queries"]["q2_street_parts"] > 0 and "errors" not in result
