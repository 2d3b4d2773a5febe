"""Silver-layer derived fields and the rolling volatility of the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlegap.functions.columns import PRICE_TYPE, pair_window


def daily_range(df: DataFrame) -> DataFrame:
    """``daily_range = high - low`` in price units, decimal(10,5)."""
    return df.withColumn("daily_range", (F.col("high") - F.col("low")).try_cast(PRICE_TYPE))


def daily_return(df: DataFrame) -> DataFrame:
    """Close-to-close change in percent, decimal(10,5); NULL on an instrument's
    first bar and where the value does not fit decimal(10,5).

    ``lag`` over the instrument window: one shuffle by pair, one sort by date.
    The instrument's rows sit in one task; after dedup a pair has at most one
    row per calendar day, so that task is bounded by the calendar, not by the
    table size (20 years of daily bars is ~7,300 rows).
    """
    prev = F.lag("close", 1).over(pair_window())
    pct = F.try_divide(F.col("close") - prev, prev) * F.lit(100)
    return df.withColumn("daily_return", pct.try_cast(PRICE_TYPE))


def derive_fields(df: DataFrame) -> DataFrame:
    """Both derived fields in one Project over one Window."""
    prev = F.lag("close", 1).over(pair_window())
    pct = F.try_divide(F.col("close") - prev, prev) * F.lit(100)
    return df.withColumns({
        "daily_range": (F.col("high") - F.col("low")).try_cast(PRICE_TYPE),
        "daily_return": pct.try_cast(PRICE_TYPE),
    })


def rolling_volatility(silver: DataFrame, days: int = 20, *,
                       name: str = "volatility_20d") -> DataFrame:
    """Mean ``daily_range`` over the current and ``days - 1`` preceding bars,
    rounded to 5 places (decimal(10,5)); the first bars average what exists.
    """
    if days < 1:
        raise ValueError(f"days must be >= 1, not {days}")
    w = pair_window().rowsBetween(-(days - 1), Window.currentRow)
    avg = F.round(F.avg("daily_range").over(w), 5).cast(PRICE_TYPE)
    return silver.withColumn(name, avg)


__all__ = ["daily_range", "daily_return", "derive_fields", "rolling_volatility"]
