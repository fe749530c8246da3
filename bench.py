"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query is
run to its last row (into a sink that discards them); the best of BENCH_RUNS
counts. ``warmup`` is the cost of the very first query in the session.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "scan_csv_roundtrip",
    "sink_parquet_roundtrip",
    "parse_locale_numbers",
    "validate_counts",
    "dedup_keep_first",
    "dedup_exact",
    "describe_table",
    "correlation_matrix",
    "gap_fill_global",
    "gap_fill_per_key",
    "impute_global",
    "impute_grouped",
    "quartiles_exact",
    "quartiles_approx",
    "winsorize",
    "clean_daily_series",
    "clean_readings",
    "clean_measurements",
    "quality_report",
    "train_test_split",
    "ols_fit",
    "ols_metrics",
    "cross_validate",
    "train_report",
    "score_table",
    "score_requests",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-"))
    return spark


def run(spark: SparkSession, name: str, data: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    data = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    warmup = run(spark, "validate_counts", data)
    times = {n: round(min(run(spark, n, data) for _ in range(runs)), 3) for n in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "warmup": round(warmup, 3),
                "sf": os.path.basename(data.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
