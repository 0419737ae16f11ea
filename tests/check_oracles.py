"""Compare registered queries with their SQL: python tests/check_oracles.py [sf dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402
from tidegauge.session import local_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, failed = local_session(), connect(sf_dir), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in wanted or queries:
        start = time.perf_counter()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = problem or "equal"
            else:
                problem, note = "", f"no SQL, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.perf_counter() - start:6.2f}s  {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
