"""Run every registered query against its DuckDB oracle at one scale.

    python tests/run_oracle.py /root/testdata/sf0.01 [query ...]

Prints one line per query (OK / BAD / ERR, seconds) and a final count; the
comparison is the driver's: row count, column names, order-insensitive values.
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)

import __spark_entry__ as E  # noqa: E402
from compare import compare, duck  # noqa: E402
from credit_signals.session import session  # noqa: E402


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = session("credit-signals-oracle", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    queries, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if only and name not in only:
            continue
        t = time.perf_counter()
        try:
            df = fn(spark, sf)
            diff = compare(df, con, sql[name]) if name in sql else (df.count() and None)
            status = "OK " if diff is None else "BAD"
        except Exception as exc:  # noqa: BLE001 - report and continue
            status, diff = "ERR", f"{type(exc).__name__}: {str(exc)[:300]}"
        bad += status != "OK "
        kind = "" if name in sql else "(rows only)"
        print(f"{status} {name:28s} {time.perf_counter() - t:5.1f}s {kind} {diff or ''}", flush=True)
    print(f"bad: {bad} of {len(only or queries)}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
