"""Driver contract for bench.py: run as a separate process, it prints exactly
one JSON line on stdout with the fields the driver records."""

import json
import os
import subprocess
import sys

from .conftest import SF001

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_WARM_DIR="/nonexistent", BENCH_CPUS="4",
               BENCH_REPEAT="1", BENCH_PIPELINE="0")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, cwd=REPO,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, lines
    rec = json.loads(lines[0])
    assert rec["metric"] == "total_query_seconds" and rec["unit"] == "sec"
    assert rec["sf"] == 0.001
    import __spark_entry__ as entry_module

    assert set(rec["queries"]) == set(entry_module.queries())
    assert all(isinstance(v, (int, float)) and v >= 0 for v in rec["queries"].values())
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-3
