"""Detection, later-bar fill and first fill on one very long instrument.

Usage: python scripts/long_instrument.py [n_bars ...]   (default: 20000 200000)
One synthetic instrument of n daily bars (a deterministic wavy price), so the
whole series sits in one window partition: shows how the per-instrument
steps grow with the instrument's length.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from candlegap.operators import detect_gaps, gap_fill_future, gap_first_fill  # noqa: E402


def bars(spark: SparkSession, n: int) -> DataFrame:
    i = F.col("id")
    mid = F.lit(100) + F.sin(i / 37) * 10 + F.sin(i / 5) * 3 + (i % 11) * 0.07
    return spark.range(n).select(
        F.date_add(F.lit("1900-01-01").cast("date"), i.cast("int")).alias("date"),
        F.lit("LONG").alias("from_symbol"), F.lit("USD").alias("to_symbol"),
        mid.cast("decimal(10,5)").alias("open"),
        (mid + 1).cast("decimal(10,5)").alias("high"),
        (mid - 1).cast("decimal(10,5)").alias("low"),
        (mid + F.sin(i) * 0.5).cast("decimal(10,5)").alias("close"),
    )


def main() -> None:
    sizes = [int(a) for a in sys.argv[1:]] or [20_000, 200_000]
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    steps = (("detect", detect_gaps), ("future", gap_fill_future), ("first_fill", gap_first_fill))
    for n in sizes:
        b = bars(spark, n).cache()
        b.count()
        for name, fn in steps:
            fn(b).write.format("noop").mode("overwrite").save()  # warm-up
            t0 = time.perf_counter()
            fn(b).write.format("noop").mode("overwrite").save()
            print(f"{n:>9,d} bars  {name:<10s} {time.perf_counter() - t0:6.2f} s")
        b.unpersist()
    spark.stop()


if __name__ == "__main__":
    main()
