"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default the sf0.1 tables) and ``BENCH_CPUS`` (default 8) choose the input
and the cores; names as arguments choose queries. Every query runs in full: results go to
Spark's ``noop`` sink. The first run of each query warms it up; of three more the fastest
counts, as the machine may be shared.
"""

from __future__ import annotations

import json
import os
import sys
import time

from millrace.queries import QUERIES
from millrace.session import local_session

HEADLINE = [
    "audit_rollup",
    "minute_rollup",
    "hour_type_rollup",
    "lineitem_rollup",
    "hour_grid",
    "json_keys",
    "meter_flat",
    "meter_zoned",
    "three_columns",
    "plays_flat",
    "envelope_to_rows",
    "list_to_table",
    "turns_flat",
    "quality_report",
    "duplicate_keys",
    "repeated_rows",
    "one_row_per_key",
    "keyed_append",
    "newest_files",
    "files_by_time",
    "batch_union",
    "partition_roundtrip",
    "metering_job",
    "audit_job",
    "plays_job",
    "replies_job",
    "keyed_append_roundtrip",
    "landing_roundtrip",
    "stream_rollup",
    "stream_usage",
    "stream_readings",
    "stream_keyed",
    "versioned_days",
    "dynamic_rollup",
    "merged_rollup",
    "reload_changes",
    "random_keys",
    "stream_late",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run_once(spark, name, sf_dir)
        seconds[name] = round(min(run_once(spark, name, sf_dir) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
