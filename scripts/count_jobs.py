"""Jobs, stages and shuffle exchanges per layer job.

Usage: python scripts/count_jobs.py [sf_dir]
Builds the raw zone from ``events``, then runs bronze, silver and gold as
batch jobs under separate job groups and reports what each one cost.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from candlegap import catalog  # noqa: E402
from candlegap.plans import pipeline  # noqa: E402
from candlegap.sinks.files import write_raw_json  # noqa: E402
from candlegap.sinks.paths import scratch_path  # noqa: E402

RUN_TS = "2024-02-01T00:00:00Z"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    root = scratch_path(spark, "jobs")
    raw, bronze, silver, gold = (f"{root}/{x}" for x in ("raw", "bronze", "silver", "gold"))
    write_raw_json(catalog.bronze(spark, sf, malformed=True), raw)
    steps = {
        "run_bronze": lambda: pipeline.run_bronze(spark, raw, bronze, run_ts=RUN_TS),
        "run_silver": lambda: pipeline.run_silver(spark, bronze, silver),
        "run_gold": lambda: pipeline.run_gold(spark, silver, gold, run_ts=RUN_TS),
    }
    out = {}
    for name, fn in steps.items():
        sc.setJobGroup(name, name)
        t0 = time.perf_counter()
        rows = fn()
        secs = time.perf_counter() - t0
        jobs = sc.statusTracker().getJobIdsForGroup(name)
        stages = sum(len(sc.statusTracker().getJobInfo(j).stageIds) for j in jobs)
        out[name] = {"rows": rows, "jobs": len(jobs), "stages": stages, "sec": round(secs, 2)}
    from candlegap.sources.files import scan_layer
    from candlegap.plans.pipeline import build_gold
    plan = build_gold(scan_layer(spark, silver).drop("pair"), run_ts=RUN_TS)._jdf \
        .queryExecution().executedPlan().toString()
    out["run_gold"]["exchanges_in_plan"] = plan.count("Exchange ")
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
