"""The driver contract: bench.py prints one JSON line; __spark_entry__.py
loads by file path from any working directory."""

from __future__ import annotations

import importlib.util
import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_QUERIES="vendor_counts",
               BENCH_REPEAT="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"vendor_counts"}


def test_entry_module_loads_by_path():
    spec = importlib.util.spec_from_file_location("entry_by_path", ROOT / "__spark_entry__.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    qs, sql = mod.queries(), mod.oracle_sql()
    from tripspark.plans.catalog import QUERIES, ROWS_ONLY

    assert set(sql) <= set(qs) and set(QUERIES) - set(sql) == ROWS_ONLY
