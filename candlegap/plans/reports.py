"""The analysis reports over the silver bars and the gold gaps.

Every report works on tables holding many instruments: groupings and
windows carry the pair keys, so one instrument never mixes with another.
Sizes are reported as ``ABS(fvg_size_pips)``, so the reports read the same
whether gold was built with ordered or positional levels.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlegap.functions.columns import PAIR_KEYS
from candlegap.operators.enrich import rolling_volatility
from candlegap.operators.positions import top_with_ties, with_positions

PAIR = list(PAIR_KEYS)

#: The order of each report's rows, descending where marked; the instrument and the date break ties.
ORDERS = {
    "report_gaps_by_size": ("-fvg_size_pips", *PAIR, "date"),
    "report_active_gaps": ("-date", *PAIR),
    "report_fill_rate": ("-fill_rate_pct", "fvg_type"),
    "report_monthly_activity": ("-month", *PAIR),
    "report_volatility": ("-date", *PAIR),
    "report_largest_moves": ("move_rank", *PAIR, "date"),
}


def report_order(name: str) -> list[Column]:
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in ORDERS[name]]


def positioned(report: DataFrame, name: str) -> DataFrame:
    """A report's rows with their ``position`` in its order."""
    return with_positions(report, *report_order(name))


def _abs_size() -> Column:
    return F.abs(F.col("fvg_size_pips")).alias("fvg_size_pips")


def report_gaps_by_size(gold: DataFrame) -> DataFrame:
    """All gaps with absolute size and a Filled/Active status, largest first."""
    status = F.when(F.col("is_filled") == 1, F.lit("Filled")).otherwise(F.lit("Active"))
    return gold.select(
        "date", *PAIR, "fvg_type", "fvg_high", "fvg_low", _abs_size(), "is_filled",
        status.alias("status"),
    ).orderBy(*report_order("report_gaps_by_size"))


def report_active_gaps(gold: DataFrame) -> DataFrame:
    """Open gaps (``is_filled = 0``), newest first; the filter reaches a
    Parquet scan of gold as a pushed predicate."""
    return (gold.filter(F.col("is_filled") == 0)
            .select("date", *PAIR, "fvg_type", "fvg_high", "fvg_low", _abs_size())
            .orderBy(*report_order("report_active_gaps")))


def percent(part: Column, whole: Column) -> Column:
    """ROUND(part * 100.0 / whole, 2) in exact decimal arithmetic."""
    return F.round(part * F.lit(Decimal("100.0")) / whole, 2).cast("decimal(5,2)")


def report_fill_rate(gold: DataFrame) -> DataFrame:
    """Per gap type: total, filled, unfilled and fill rate in percent.

    One hash aggregation with a partial step per task, so only one row per
    (task, type) is shuffled whatever the table size.
    """
    filled = F.sum("is_filled")
    return (gold.groupBy("fvg_type").agg(
        F.count(F.lit(1)).alias("total_fvgs"),
        filled.alias("filled_count"),
        (F.count(F.lit(1)) - filled).alias("unfilled_count"),
        percent(filled, F.count(F.lit(1))).alias("fill_rate_pct"),
    ).orderBy(*report_order("report_fill_rate")))


def report_monthly_activity(gold: DataFrame, *, by_pair: bool = True) -> DataFrame:
    """Per (pair,) month: gap counts by type, mean and largest absolute size.

    ``month`` is ``date_trunc('month', date)`` (a timestamp). ``by_pair``
    keeps instruments apart, as a per-instrument table would.
    """
    size = F.abs(F.col("fvg_size_pips"))
    keys = (PAIR if by_pair else []) + [F.date_trunc("month", F.col("date")).alias("month")]
    return (gold.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_fvgs"),
        F.sum(F.when(F.col("fvg_type") == "bullish", 1).otherwise(0)).alias("bullish_fvgs"),
        F.sum(F.when(F.col("fvg_type") == "bearish", 1).otherwise(0)).alias("bearish_fvgs"),
        F.round(F.avg(size), 2).cast("decimal(10,2)").alias("avg_size_pips"),
        F.round(F.max(size), 2).cast("decimal(10,2)").alias("max_size_pips"),
    ).orderBy(F.col("month").desc(), *(PAIR if by_pair else [])))


def report_volatility(silver: DataFrame, gold: DataFrame | None = None,
                      days: int = 20) -> DataFrame:
    """Each bar with its rolling ``days``-bar mean range beside the gap (if
    any) dated on it.

    Without ``gold`` the gaps are derived in the same pass: the rolling mean
    and the lag/lead columns share one partitioning and order, so the whole
    report is one shuffle by instrument and no join (a bar carries at most
    one gap, dated on itself). With a stored ``gold`` table it is a left
    join on (pair, date) -- no fan-out for the same reason; Spark/AQE pick
    broadcast only when the gap side's measured size is under the broadcast
    threshold, sort-merge otherwise.
    """
    from candlegap.operators.gaps import detect_gaps_inline

    if gold is None:
        both = detect_gaps_inline(rolling_volatility(silver, days))
        return (both.select("date", *PAIR, "daily_range", "volatility_20d", "daily_return",
                            "fvg_type", _abs_size())
                .orderBy(F.col("date").desc(), *PAIR))
    vol = rolling_volatility(silver, days).select(
        "date", *PAIR, "daily_range", "volatility_20d", "daily_return")
    gaps = gold.select("date", *PAIR, "fvg_type", _abs_size())
    return (vol.join(gaps, ["date", *PAIR], "left")
            .select("date", *PAIR, "daily_range", "volatility_20d", "daily_return",
                    "fvg_type", "fvg_size_pips")
            .orderBy(F.col("date").desc(), *PAIR))


def _moves(silver: DataFrame, window: Window, top: int) -> DataFrame:
    rank = F.rank().over(window)
    return (silver.select("date", *PAIR, "open", "high", "low", "close", "daily_range",
                          "daily_return", rank.alias("move_rank"))
            .filter(F.col("move_rank") <= top))


def report_largest_moves(silver: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` largest absolute daily returns over all bars, ties share a
    rank (so more rows may pass); NULL returns rank last.

    A rank filter over a global order: Spark plans a ``WindowGroupLimit``
    below the single-partition exchange, so each task ships at most its own
    top rows (plus ties) -- the exchange is bounded by tasks x top.
    """
    w = Window.orderBy(F.abs(F.col("daily_return")).desc_nulls_last())
    return _moves(silver, w, top).orderBy("move_rank", *PAIR, "date")


def report_largest_moves_in_parallel(silver: DataFrame, top: int = 10) -> DataFrame:
    """``report_largest_moves`` in two passes (``top_with_ties``), for tables where very many bars
    tie or have no return: those would all meet in the one partition of a global window. Runs
    one job for the ``top`` largest values when called."""
    rows = silver.select("date", *PAIR, "open", "high", "low", "close", "daily_range", "daily_return")
    return top_with_ties(rows, F.abs(F.col("daily_return")), top, name="move_rank").orderBy(
        *report_order("report_largest_moves"))


def largest_moves_per_pair(silver: DataFrame, top: int = 10) -> DataFrame:
    """``report_largest_moves`` within each instrument (group limit per pair)."""
    w = Window.partitionBy(*PAIR).orderBy(F.abs(F.col("daily_return")).desc_nulls_last())
    return _moves(silver, w, top)


def gap_summary(gold: DataFrame) -> DataFrame:
    """One row: total, bullish, bearish, filled, unfilled -- one aggregation
    instead of five counting jobs."""
    return gold.agg(
        F.count(F.lit(1)).alias("total_fvgs"),
        F.count_if(F.col("fvg_type") == "bullish").alias("bullish_fvgs"),
        F.count_if(F.col("fvg_type") == "bearish").alias("bearish_fvgs"),
        F.count_if(F.col("is_filled") == 1).alias("filled_fvgs"),
        F.count_if(F.col("is_filled") == 0).alias("unfilled_fvgs"),
    )


def largest_gaps(gold: DataFrame, top: int = 10, *, order: str = "abs") -> DataFrame:
    """The ``top`` gaps by size (ties broken by pair, date): a TakeOrdered --
    each task keeps its own top rows, the driver merges tasks x top rows.

    ``order="abs"`` ranks by absolute size; ``order="signed"`` by the stored
    value, which over positional gold (negative bearish sizes) reproduces a
    listing where bearish gaps sink to the end.
    """
    if order not in ("abs", "signed"):
        raise ValueError(f"order must be 'abs' or 'signed', not {order!r}")
    size = F.col("fvg_size_pips")
    key = F.abs(size) if order == "abs" else size
    return (gold.select("date", *PAIR, "fvg_type", "fvg_high", "fvg_low", "fvg_size_pips",
                        "is_filled")
            .orderBy(key.desc(), *PAIR, "date")
            .limit(top))


def latest_active_gaps(gold: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` newest open gaps (ties broken by pair)."""
    return (gold.filter(F.col("is_filled") == 0)
            .select("date", *PAIR, "fvg_type", "fvg_high", "fvg_low", "fvg_size_pips")
            .orderBy(F.col("date").desc(), *PAIR)
            .limit(top))


def latest_bars(silver: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` newest bars (ties broken by pair) -- a layer preview."""
    cols = [c for c in ("date", *PAIR, "open", "high", "low", "close", "daily_range",
                        "daily_return") if c in silver.columns]
    return silver.select(*cols).orderBy(F.col("date").desc(), *PAIR).limit(top)


def last_bar_date(silver: DataFrame) -> DataFrame:
    """Per instrument: last bar date and bar count (freshness check)."""
    return silver.groupBy(*PAIR).agg(F.max("date").alias("last_date"),
                                    F.count(F.lit(1)).alias("n_bars"))


__all__ = [
    "gap_summary", "largest_gaps", "largest_moves_per_pair", "last_bar_date",
    "latest_active_gaps", "latest_bars", "report_active_gaps", "report_fill_rate",
    "report_gaps_by_size", "report_largest_moves", "report_largest_moves_in_parallel",
    "report_monthly_activity", "report_order", "report_volatility", "positioned",
]
