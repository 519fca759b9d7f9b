"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores. Each
question runs once to warm up and then three times, of which the median counts; loads, which
write what they read back, run once after a warm-up at the same size.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from cabrank.plans.catalogue import QUERIES
from cabrank.session import build_session

QUESTIONS = [
    "trips_on_day",
    "daily_max_tip",
    "top_tip_day",
    "top_destination",
    "priciest_pair",
    "trips_in_range",
    "distinct_bases",
    "trips_for_bases",
    "avg_by_pair",
    "join_dim_role_playing",
    "key_check",
]
LOADS = [
    "scan_csv_chunked",
    "convert_csv_parquet",
    "sink_table_append",
    "row_ordinal",
    "row_ordinal_source",
    "ctas_partitioned",
    "clustered_layout",
    "relayout_by_dataset",
    "monthly_backfill",
    "registry_fanout",
]


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        "cabrank-bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in [n for n in QUESTIONS + LOADS if not only or n in only]:
        seconds(spark, sf_dir, name)
        runs = 3 if name in QUESTIONS else 1
        timings[name] = statistics.median(seconds(spark, sf_dir, name) for _ in range(runs))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "trip_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in timings.items()},
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
