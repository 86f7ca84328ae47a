"""Time the oracle SQL of every registered query on DuckDB with one thread (the original
pipeline's engine setting), as a single-node reference point for bench.py. Each query is
materialised as a table (CREATE TABLE AS), as the original builds its models. One JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import oracle_queries  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    threads = int(os.environ.get("DUCKDB_THREADS", "1"))
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for name, sql in oracle_queries().items():
        runs = []
        for _ in range(3):
            t = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE bench_out AS {sql}")
            runs.append(time.perf_counter() - t)
        out[name] = round(statistics.median(runs), 3)
    print(json.dumps({"engine": f"duckdb {duckdb.__version__}", "threads": threads,
                      "sf_dir": sf_dir, "queries": out, "total": round(sum(out.values()), 3)}))


if __name__ == "__main__":
    main()
