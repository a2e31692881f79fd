"""Time the oracle SQL in DuckDB on the same files (a single-node yardstick).

usage: python tools/duckdb_yardstick.py [sf_dir]  -> one JSON line
"""

from __future__ import annotations

import json
import statistics
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from shelfwise.plans.oracle import ORACLE  # noqa: E402

TABLES = ["region", "nation", "supplier", "part", "lineitem"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for name, sql in ORACLE.items():
        samples = []
        for i in range(4):
            t0 = time.perf_counter()
            con.execute(sql).fetchall()
            if i:
                samples.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(samples), 4)
    print(json.dumps({"engine": "duckdb", "value": round(sum(out.values()), 3), "queries": out}))


if __name__ == "__main__":
    main()
