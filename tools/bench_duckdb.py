"""Time the oracle SQL on DuckDB over the same files; one JSON line like bench.py.

Models are built as tables in order, each timed alone; `full_refresh` is their sum.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from oracle_models import MODELS, _whole  # noqa: E402
from oracle_queries import OPERATORS  # noqa: E402
from table_feeds import FEEDS, duckdb_feed  # noqa: E402
from tools.check_oracles import connect  # noqa: E402


def timed(con, sql: str) -> float:
    start = time.perf_counter()
    con.execute(sql)
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    con = connect(folder)
    con.execute(f"SET threads = {os.environ.get('BENCH_CPUS', '8')}")
    for name in FEEDS:
        con.execute(f"CREATE TABLE {name} AS {duckdb_feed(name)}")
    seconds, total = {}, 0.0
    for name, sql in MODELS.items():
        took = timed(con, f"CREATE TABLE {name} AS {_whole(sql)}")
        total += took
        if name in HEADLINE:
            seconds[name] = took
    for name in HEADLINE:
        if name in OPERATORS:
            seconds[name] = timed(con, f"CREATE OR REPLACE TEMP TABLE out AS {OPERATORS[name]}")
    print(json.dumps({"full_refresh": round(total, 3), **seconds}))


if __name__ == "__main__":
    main()
