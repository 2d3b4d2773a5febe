"""Adapter from the driver's ``events`` table to daily price bars.

The given tables hold no open/high/low/close data, so bars are derived from
events: one bar per (UTC day, user), the user standing in for an instrument
``U<user_id>/USD``. This is test-data plumbing, not a library operator; every
query that needs bars starts here so its work grows with ``events``.

Scale: one partial + final hash aggregate keyed by (day, user). The partial
step collapses a hot user's events map-side before the shuffle, so a user that
holds a third of all events still ships one row per (task, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlegap.functions.columns import PRICE_TYPE


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The (read-only) ``events`` table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def event_bars(events: DataFrame) -> DataFrame:
    """Numeric daily bars: bar_date, user_id, o, h, l, c (double), stamp.

    open/close are the values of the first/last event by (ts, event_id).
    """
    order = F.struct("ts", "event_id")
    return (
        events.groupBy(F.to_date("ts").alias("bar_date"), "user_id")
        .agg(
            F.min_by("value", order).alias("o"),
            F.max("value").alias("h"),
            F.min("value").alias("l"),
            F.max_by("value", order).alias("c"),
            F.max("ts").alias("stamp"),
        )
    )


def _text(price: Column) -> Column:
    # decimal(10,5) first, so both engines print the same digits ("6.55000")
    return price.cast(PRICE_TYPE).cast("string")


def bars_to_bronze(
    bars: DataFrame,
    *,
    malformed: bool = False,
    price_factor: float = 1.0,
    stamp_shift_days: int = 0,
    spread_months: bool = False,
) -> DataFrame:
    """Bronze rows (all text but the stamp) from numeric bars.

    Variants, each a fixed rule an SQL oracle can apply too:
    ``malformed``: by user_id % 7 -- 0 open='bad', 1 close=NULL, 2 high/low
    swapped, 3 low='0', 4 open='-1'. ``price_factor`` scales every price,
    ``stamp_shift_days`` moves the stamp later, ``spread_months`` adds
    31 * (user_id % 6) days to the date so the bars span several months.
    """
    k = F.col("user_id") % 7
    o, h, l, c = (F.col(x) * F.lit(price_factor) if price_factor != 1 else F.col(x)
                  for x in ("o", "h", "l", "c"))
    open_s, high_s, low_s, close_s = _text(o), _text(h), _text(l), _text(c)
    if malformed:
        open_s = (F.when(k == 0, F.lit("bad")).when(k == 4, F.lit("-1"))
                  .otherwise(open_s))
        close_s = F.when(k == 1, F.lit(None).cast("string")).otherwise(close_s)
        high_s, low_s = (
            F.when(k == 2, low_s).otherwise(high_s),
            F.when(k == 2, high_s).when(k == 3, F.lit("0")).otherwise(low_s),
        )
    day = F.col("bar_date")
    if spread_months:
        day = F.date_add(day, (F.col("user_id") % 6 * 31).cast("int"))
    stamp = F.col("stamp").cast("timestamp")
    if stamp_shift_days:
        stamp = stamp + F.make_dt_interval(F.lit(stamp_shift_days))
    return bars.select(
        day.cast("string").alias("date"),
        open_s.alias("open"),
        high_s.alias("high"),
        low_s.alias("low"),
        close_s.alias("close"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("from_symbol"),
        F.lit("USD").alias("to_symbol"),
        stamp.alias("_ingest_timestamp"),
        F.lit("events").alias("_source"),
    )


def events_to_bronze(events: DataFrame, **variant) -> DataFrame:
    return bars_to_bronze(event_bars(events), **variant)


def events_as_bronze_copies(events: DataFrame) -> DataFrame:
    """Every event as its own bronze bar (all four prices = value, stamp = ts):
    many copies per (day, instrument), the input of the dedup check."""
    v = _text(F.col("value"))
    return events.select(
        F.to_date("ts").cast("string").alias("date"),
        v.alias("open"), v.alias("high"), v.alias("low"), v.alias("close"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("from_symbol"),
        F.lit("USD").alias("to_symbol"),
        F.col("ts").cast("timestamp").alias("_ingest_timestamp"),
        F.concat(F.lit("event:"), F.col("event_id").cast("string")).alias("_source"),
    )
