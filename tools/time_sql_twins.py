"""Time the SQL twins of the benchmark queries in DuckDB, as a single-node yardstick.

usage: python tools/time_sql_twins.py [sf_dir] [threads]
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE, RUNS  # noqa: E402
from stratum.workloads.oracles import all_oracles  # noqa: E402
from tools.check_oracles import connect  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    connection = connect(sf_dir)
    connection.execute(f"SET threads TO {sys.argv[2] if len(sys.argv) > 2 else os.cpu_count()}")
    for name in HEADLINE:
        seconds = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            connection.execute(f"CREATE OR REPLACE TEMP TABLE result AS {all_oracles()[name]}")
            seconds.append(time.perf_counter() - start)
        print(f"{name:28s} {statistics.median(seconds[1:]):.3f}")


if __name__ == "__main__":
    main()
