"""A third of all rows on one key: results stay whole and exact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from candlegap.operators import dedup_latest, upsert_bars
from candlegap.plans import build_silver, reports
from candlegap.schemas import BRONZE_SCHEMA


def _copies(spark, n=30000):
    """n bronze rows over 200 instruments x 5 days, a third of them copies of
    one (day, instrument) with increasing stamps."""
    base = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id") % 200).alias("inst"),
        F.when(F.col("id") < n // 3, F.lit(1)).otherwise(
            F.floor(F.col("id") / 200) % 5 + 1).alias("day"),
    )
    return base.select(
        F.format_string("2024-01-%02d", "day").alias("date"),
        *[(F.lit(1) + (F.col("id") % 97) / 1000).cast("decimal(10,5)").cast("string").alias(c)
          for c in ("open", "high", "low", "close")],
        F.concat(F.lit("I"), F.col("inst").cast("string")).alias("from_symbol"),
        F.lit("USD").alias("to_symbol"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
         + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("_ingest_timestamp"),
        F.lit("test").alias("_source"),
    )


def test_hot_copy_group_dedups_exactly(spark):
    n = 30000
    df = _copies(spark, n)
    assert [f.name for f in df.schema] == BRONZE_SCHEMA.fieldNames()
    out = dedup_latest(df.repartition(8))
    hot = out.filter((F.col("from_symbol") == "I0") & (F.col("date") == "2024-01-01")).collect()
    assert len(hot) == 1
    # the latest stamp of the hot group: the largest id that maps to (I0, day 1)
    last = max(i for i in range(n) if i < n // 3 or (i % 200 == 0 and (i // 200) % 5 == 0))
    assert hot[0]["_ingest_timestamp"] == dt.datetime(2024, 1, 1) + dt.timedelta(seconds=last)
    want = df.select("date", "from_symbol").distinct().count()
    assert out.count() == want


def test_hot_key_through_silver_and_reports(spark):
    df = _copies(spark)
    silver = build_silver(df)
    assert silver.count() == df.select("date", "from_symbol").distinct().count()
    counts = {r["from_symbol"]: r["n_bars"] for r in reports.last_bar_date(silver).collect()}
    assert counts["I0"] == 5 and len(counts) == 200
    again = upsert_bars(df, df)
    assert again.count() == silver.count()
