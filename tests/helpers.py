"""Hand-made bar tables for the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SILVER_TEXT = ("date string, from_symbol string, to_symbol string, open string, high string, "
               "low string, close string")


def silver_bars(spark: SparkSession, rows, pair=("EUR", "USD")) -> DataFrame:
    """rows: (date, open, high, low, close) as text -> typed silver-like bars."""
    data = [(d, pair[0], pair[1], o, h, lo, c) for d, o, h, lo, c in rows]
    df = spark.createDataFrame(data, SILVER_TEXT)
    return df.select(
        F.col("date").cast("date").alias("date"),
        *[F.col(c).cast("decimal(10,5)").alias(c) for c in ("open", "high", "low", "close")],
        "from_symbol", "to_symbol",
        F.current_timestamp().alias("_ingest_timestamp"),
        F.lit("test").alias("_source"),
    )


# The three three-bar tables of the reference's unit tests.
BULLISH_ROWS = [
    ("2024-01-01", "1.09500", "1.10000", "1.09000", "1.09800"),
    ("2024-01-02", "1.09800", "1.11000", "1.09700", "1.10800"),
    ("2024-01-03", "1.10800", "1.11500", "1.10500", "1.11200"),
]
BEARISH_ROWS = [
    ("2024-01-01", "1.11500", "1.12000", "1.11000", "1.11200"),
    ("2024-01-02", "1.11200", "1.11300", "1.10200", "1.10400"),
    ("2024-01-03", "1.10400", "1.10500", "1.09800", "1.10000"),
]
NO_GAP_ROWS = [
    ("2024-01-01", "1.10000", "1.10500", "1.09500", "1.10200"),
    ("2024-01-02", "1.10200", "1.10800", "1.09800", "1.10500"),
    ("2024-01-03", "1.10500", "1.11000", "1.10100", "1.10700"),
]
