"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times; its median is
reported. Results go to a no-op sink: all rows are computed, none are collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickerloom.catalog.queries import BUILDERS  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "vwap_1h", "vwap_1d", "vwap_lines_1d", "anomaly_bounds_1d",
    "outlier_trades", "outlier_trades_interval", "outlier_summary",
    "dedup_trades", "duplicate_stats_lines", "replay_audit",
    "reconcile_summary", "dq_checks", "lateness_audit",
    "volume_leaders", "liquidity_most", "volatility_most", "latest_window_board",
    "source_breakdown", "data_summary", "table_health",
    "ticker_counts", "salted_count", "ticker_skew", "sector_enrichment",
    "key_distribution", "parsed_messages", "vendor_normalize", "session_trades",
    "warehouse_projection", "asof_version_counts",
    "stream_vwap_closed_windows", "stream_bronze", "stream_fan_out_health",
]


def measure(spark: SparkSession, name: str) -> float:
    def run() -> float:
        started = time.perf_counter()
        BUILDERS[name](spark, SF).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    run()
    return statistics.median(run() for _ in range(RUNS))


def main() -> None:
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: round(measure(spark, name), 4) for name in chosen}
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 4),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(SF.rstrip("/")),
        "cpus": int(CPUS), "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
