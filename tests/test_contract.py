"""Driver contract: bench.py prints one JSON line with the required keys, and
__spark_entry__ exposes entry / queries / oracle_sql."""
import json
import os
import subprocess
import sys

import __spark_entry__ as E

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_module_contract():
    assert callable(E.entry)
    assert all(callable(f) for f in E.queries().values())
    assert all(isinstance(s, str) and s.strip() for s in E.oracle_sql().values())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_KEYS="totals_today,ranking_categories")
    out = subprocess.run([sys.executable, "bench.py"], cwd=REPO, env=env, capture_output=True,
                         text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["failed"] == []
    assert {"totals_today", "ranking_categories"} <= set(d["queries"])
