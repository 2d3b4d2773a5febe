"""Headline timings: prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is materialised in full with the ``noop`` sink (every column of
every row computed, nothing collected to the driver), after one untimed
warm-up run that pays JVM start-up. Each query runs ``BENCH_RUNS`` times
(default 3) and reports the median, since single local runs vary by ~30%.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from candlegap.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "build_silver",
    "build_gold",
    "detect_gaps",
    "gap_fill_future",
    "gap_first_fill",
    "dedup_latest",
    "upsert_bars",
    "report_fill_rate",
    "report_monthly_activity",
    "report_volatility",
    "report_largest_moves",
    "gap_summary",
    "flatten_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .appName("candlegap-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", str(max(2 * cpus, 8)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["report_fill_rate"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    timings = {}
    for name in HEADLINE:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
