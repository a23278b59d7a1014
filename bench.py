"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the fastest run
counts. A run covers everything the query does, including the files it writes
on the way, and ends when its whole result has been produced.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.registry import QUERIES  # noqa: E402

HEADLINE = [
    "scan_csv_comma",
    "cast_to_schema",
    "encode_envelope",
    "decode_envelope",
    "decode_base64_col",
    "records_to_rows",
    "dedup_latest",
    "dedup_latest_grouped",
    "upsert_latest",
    "upsert_large_batch",
    "upsert_keep_later",
    "upsert_partitions",
    "merge_update_insert",
    "merge_large_source",
    "merge_shared_key",
    "dq_metrics",
    "dq_verification",
    "dq_uniqueness",
    "sink_partitioned",
    "rechunk",
    "load_csv_upsert",
    "load_row_count",
    "stream_decode",
    "stream_upsert_latest",
    "sql_job",
    "sql_job_window",
    "upsert_slotted_table",
    "join_as_of",
    "join_intervals",
    "dq_profile",
    "stream_windows",
]


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="millrace-bench-"))
        .getOrCreate()
    )


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(min(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
