"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default: all cores) choose data and
cores. All queries run once to warm up, then three times each; the median counts. Results go to
Spark's ``noop`` sink, so every row and column is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.session import build_session  # noqa: E402
from stratum.workloads.queries import all_queries  # noqa: E402

HEADLINE = (
    "daily_revenue",
    "daily_revenue_distinct",
    "customer_360",
    "customer_ltv",
    "revenue_by_segment",
    "dedupe_latest",
    "silver_transactions",
    "transactions_enriched",
    "scd2_merge",
    "point_in_time_join",
    "dq_transactions",
    "api_unwrap",
)
RUNS = 3


def bench_session(cpus: str):
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            # The test files hold one row group each, so a scan is one task, and whatever is joined
            # to it by broadcast stays in that task. Shuffling all but tiny tables uses all cores.
            "spark.sql.autoBroadcastJoinThreshold": "1m",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "1m",
            # The default of 1 MB would leave shuffles of this size to one or two tasks.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_factor(sf_dir: str) -> float | str:
    name = os.path.basename(sf_dir)
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def write_out(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    chosen = sys.argv[1:] or HEADLINE
    spark = bench_session(cpus)
    queries = all_queries()

    def run(name: str) -> None:
        write_out(queries[name](spark, sf_dir))

    for name in chosen:
        run(name)
    medians = {
        name: round(statistics.median(seconds(lambda n=name: run(n)) for _ in range(RUNS)), 3)
        for name in chosen
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": scale_factor(sf_dir),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
