"""Growth check: core queries on the sf0.1 events replicated k times.

Usage: python scripts/scale_check.py [k ...]   (default: 1 5 20)
Each copy of ``events`` gets its own users (user_id + copy * 1e6) and event
ids, so bars, instruments and gaps grow k-fold. The replicated tables are
written once under the session's shared checkpoint folder.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from candlegap.catalog import QUERIES  # noqa: E402
from candlegap.sinks.paths import scratch_path  # noqa: E402

BASE = "/root/testdata/sf0.1"
CHECK = ["build_silver", "build_gold", "gap_fill_future", "gap_first_fill", "report_fill_rate",
         "report_volatility", "report_largest_moves", "dedup_latest"]


def main() -> None:
    ks = [int(a) for a in sys.argv[1:]] or [1, 5, 20]
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{BASE}/events.parquet")
    n = events.count()
    dirs = {}
    for k in ks:
        d = scratch_path(spark, f"events-x{k}")
        copies = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        (copies.select(
            (F.col("event_id") + F.col("copy") * 10_000_000).alias("event_id"), "ts",
            (F.col("user_id") + F.col("copy") * 1_000_000).alias("user_id"),
            "event_type", "value", "props")
         .repartition(2 * k)  # splittable input, as a large table would be
         .write.parquet(f"{d}/events.parquet"))
        dirs[k] = d
    for name in CHECK:  # warm-up: JIT, Python workers
        QUERIES[name](spark, dirs[ks[0]]).write.format("noop").mode("overwrite").save()
    out = {}
    for k in ks:
        times = {}
        for name in CHECK:
            samples = []
            for _ in range(2):
                t0 = time.perf_counter()
                QUERIES[name](spark, dirs[k]).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 2)
        out[f"x{k}"] = {"events": n * k, "sec": times, "total": round(sum(times.values()), 2)}
        print(json.dumps({f"x{k}": out[f"x{k}"]}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
