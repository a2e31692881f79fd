"""bench.py prints one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="ytd_kpis,top_sellers", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    rec = json.loads(out[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {"ytd_kpis", "top_sellers"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
