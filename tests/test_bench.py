"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2",
               BENCH_QUERIES="weather_impact_summary,scan_events",
               BENCH_WARM_DIR="/nonexistent")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"weather_impact_summary", "scan_events"}
    assert d["value"] == round(sum(d["queries"].values()), 3)


def test_entry_module_loads_from_any_directory(tmp_path):
    code = ("import importlib.util as u; "
            f"s = u.spec_from_file_location('e', {os.path.join(ROOT, '__spark_entry__.py')!r}); "
            "m = u.module_from_spec(s); s.loader.exec_module(m); "
            "print(len(m.queries()), set(m.oracle_sql()) <= set(m.queries()))")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True,
                         text=True, timeout=300, check=True)
    count, same = out.stdout.split()
    assert int(count) >= 33 and same == "True"
