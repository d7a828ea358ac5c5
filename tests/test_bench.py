"""bench.py prints one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2", "BENCH_REPEATS": "1",
           "BENCH_KEYS": "market_opportunity,curate", "BENCH_MEMORY": "2g"}
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["sf"] == 0.001 and set(res["queries"]) == {"market_opportunity", "curate"}
    assert res["value"] == round(sum(res["queries"].values()), 3)
