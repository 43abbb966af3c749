"""Time the headline queries and print one JSON line.

Every query is run whole, into a sink that discards rows: once to warm up, then
``BENCH_RUNS`` times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tidemark.registry import QUERIES  # noqa: E402
from tidemark.session import configure  # noqa: E402

HEADLINE = [
    "scd2_history",
    "scd2_hot_keys",
    "dedup_latest",
    "dedup_latest_multi",
    "latest_changes",
    "change_feed",
    "replay_changes",
    "upsert",
    "document_replace",
    "document_prune",
    "affected_key_join",
    "harmonize_fact",
    "header_detail_fact",
    "harmonize_master",
    "harmonize_balance",
    "range_join_validity",
    "range_join_overlapping",
    "change_feed_digests",
    "order_rollup",
    "nest_details",
    "flatten_orders",
    "union_two_feeds",
    "surrogate_key",
    "row_checksum",
    "identity_key",
    "conditional_pivot",
    "benchmark_report",
    "volume_anomalies",
    "column_anomalies",
    "tag_rollup",
    "build_orders",
    "write_merge",
    "stream_upsert",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, directory).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(seconds[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
