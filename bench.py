"""Time the registered queries; prints one JSON line.

``BENCH_SF_DIR`` names the input tables, ``BENCH_CPUS`` the local cores. Every query
runs once to warm the JVM and then ``BENCH_RUNS`` times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from tidelog.plans.inputs import event_log
from tidelog.plans.queries import QUERIES

HEADLINE = [
    "resume_and_decode",
    "source_scan",
    "topic_subset",
    "offset_range_filter",
    "tombstones",
    "decode_payload",
    "partition_discovery",
    "partition_discovery_records",
    "start_group_full_largest",
    "scan_group_full",
    "scan_group_none_smallest",
    "scan_checkpoint",
    "scan_task_ranges",
    "read_progress",
    "merge_offsets_idle",
    "offsets_json_document",
    "offsets_json_roundtrip",
    "commit_latest",
    "group_commit",
    "stream_available_now",
    "stream_native",
]
#: Queries whose speed is also given in records per second.
THROUGHPUT = ["source_scan", "scan_group_full", "merge_offsets_idle", "stream_available_now", "stream_native"]


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidelog-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    build = timed(lambda: event_log(spark, sf_dir))
    seconds = {}
    for name in HEADLINE:
        times = [timed(lambda: run(QUERIES[name](spark, sf_dir))) for _ in range(runs + 1)]
        seconds[name] = round(statistics.median(times[1:]), 3)
    rows = {name: QUERIES[name](spark, sf_dir).count() for name in THROUGHPUT if name != "merge_offsets_idle"}
    rows["merge_offsets_idle"] = rows["scan_group_full"]
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rpartition("sf")[2],
                "cpus": cpus,
                "log_build_cold": round(build, 3),
                "rows_per_sec": {name: round(rows[name] / seconds[name]) for name in THROUGHPUT},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
