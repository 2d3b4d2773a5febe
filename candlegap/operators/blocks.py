"""Instrument windows in blocks: one instrument spread over many tasks.

A window by instrument puts all bars of an instrument into one task. Here the bars of an
instrument are cut into blocks of consecutive bars (by ranges of dates that each hold about
``BLOCK_BARS`` bars), and a window runs by (instrument, block). What crosses a block's edge is
carried in: the bar before and the bar after a block as edge rows for lag and lead, the ``k - 1``
bars before it for a rolling mean, and for "any later bar" the extremes of the later blocks, from a
scan over one row a block. Results equal the window forms of ``gaps`` and ``enrich``; bars are
in order of date, which is unique in an instrument as after ``dedup_latest``.

The first bar that fills a gap is searched level by level. A block index holds the lowest low and
the highest high of each block, in a tree of ``FANOUT`` children a node: a gap asks for the rest
of its own block, then for its siblings on each level up to the first node that reaches its
level, and from there down to the bar. Each step is an equi-join that gives one row a gap, so
nothing grows with the product of gaps and later bars, and no row leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlegap.functions.columns import DEFAULT_PIP_FACTOR, PAIR_KEYS, PRICE_TYPE, gap_size_pips
from candlegap.operators.gaps import BEARISH, BULLISH, GAP_COLUMNS, gap_levels

BLOCK_BARS = 1024
FANOUT = 32
PAIR = list(PAIR_KEYS)


def with_places(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    """``bars`` with ``_at``, each bar's place in its instrument (from 0 by date).

    Bars are counted by (instrument, month) with a map-side combine and the months' counts are
    summed up per instrument; within a month a window numbers the (at most 31) days. So neither
    step gathers an instrument's bars."""
    month = F.trunc("date", "month")
    keyed = bars.withColumn("_month", month)
    counts = keyed.groupBy(*PAIR, "_month").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*PAIR).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*PAIR, "_month", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*PAIR, "_month").orderBy("date")
    numbered = keyed.withColumn("_day", F.row_number().over(inside))
    return _null_safe(numbered, shifts, [*PAIR, "_month"]).withColumn(
        "_at", F.col("_shift") + F.col("_day") - 1).drop("_month", "_day", "_shift")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys``, NULL equal to NULL; the left side's keys stay."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return left.join(r, on, how).drop(*[f"_r_{c}" for c in keys])


def with_edges(placed: DataFrame, before: int, after: int, block_bars: int = BLOCK_BARS) -> DataFrame:
    """Each bar in its own block (``_block``, ``_own`` true), and again as an edge row in the
    next blocks whose first ``before`` bars look back at it and the previous ones whose last
    ``after`` bars look ahead. A bar is copied at most (before + after) / block_bars + 2 times."""
    at, size = F.col("_at"), F.lit(block_bars)
    first = F.greatest(F.lit(0), F.floor((at - after) / size)).cast("long")
    last = F.floor((at + before) / size).cast("long")
    return (placed.withColumn("_block", F.explode(F.sequence(first, last)))
            .withColumn("_own", F.col("_block") == F.floor(at / size)))


def block_window() -> Window:
    return Window.partitionBy(*PAIR, "_block").orderBy("date")


def neighbour_bars_in_blocks(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    """``neighbour_bars`` with an instrument in many tasks."""
    w = block_window()
    edged = with_edges(with_places(bars, block_bars), 1, 1, block_bars)
    out = edged.withColumns({
        "prev_high": F.lag("high", 1).over(w), "prev_low": F.lag("low", 1).over(w),
        "next_high": F.lead("high", 1).over(w), "next_low": F.lead("low", 1).over(w)})
    return out.where("_own").select(*bars.columns, "prev_high", "prev_low", "next_high", "next_low")


def derive_fields_in_blocks(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    """``daily_range`` and ``daily_return`` with an instrument in many tasks."""
    edged = with_edges(with_places(bars, block_bars), 1, 0, block_bars)
    prev = F.lag("close", 1).over(block_window())
    pct = F.try_divide(F.col("close") - prev, prev) * F.lit(100)
    out = edged.withColumns({"daily_range": (F.col("high") - F.col("low")).try_cast(PRICE_TYPE),
                             "daily_return": pct.try_cast(PRICE_TYPE)})
    return out.where("_own").select(*bars.columns, *[c for c in ("daily_range", "daily_return") if c not in bars.columns])


def rolling_volatility_in_blocks(silver: DataFrame, days: int = 20, *, name: str = "volatility_20d",
                                 block_bars: int = BLOCK_BARS) -> DataFrame:
    """``rolling_volatility`` with an instrument in many tasks."""
    if days < 1:
        raise ValueError(f"days must be >= 1, not {days}")
    edged = with_edges(with_places(silver, block_bars), days - 1, 0, block_bars)
    frame = block_window().rowsBetween(-(days - 1), Window.currentRow)
    mean = F.round(F.avg("daily_range").over(frame), 5).cast(PRICE_TYPE)
    return edged.withColumn(name, mean).where("_own").select(*silver.columns, name)


def _extremes(placed: DataFrame, block_bars: int) -> DataFrame:
    block = F.floor(F.col("_at") / block_bars).cast("long").alias("_block")
    return placed.groupBy(*PAIR, block).agg(F.min("low").alias("_low"), F.max("high").alias("_high"))


def future_extremes_in_blocks(silver: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    """``future_low`` / ``future_high`` over all later bars: those of the rest of the block, by a
    growing frame over the reversed order, and those of the later blocks, from one row a block."""
    placed = with_places(silver, block_bars).withColumn("_block", F.floor(F.col("_at") / block_bars).cast("long"))
    later = Window.partitionBy(*PAIR).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = _extremes(placed, block_bars).select(
        *PAIR, "_block", F.min("_low").over(later).alias("_later_low"), F.max("_high").over(later).alias("_later_high"))
    rest = (Window.partitionBy(*PAIR, "_block").orderBy(F.col("date").desc())
            .rowsBetween(Window.unboundedPreceding, -1))
    own = placed.withColumns({"_own_low": F.min("low").over(rest), "_own_high": F.max("high").over(rest)})
    return _null_safe(own, after, [*PAIR, "_block"]).select(
        *silver.columns, F.least("_own_low", "_later_low").alias("future_low"),
        F.greatest("_own_high", "_later_high").alias("future_high"))


def detect_gaps_in_blocks(silver: DataFrame, *, levels: str = "ordered", pip_factor: int | Column = DEFAULT_PIP_FACTOR,
                          block_bars: int = BLOCK_BARS) -> DataFrame:
    """``detect_gaps`` with an instrument in many tasks."""
    out = neighbour_bars_in_blocks(silver, block_bars).withColumns(gap_levels(levels))
    return (out.where("fvg_type IS NOT NULL")
            .withColumn("fvg_size_pips", gap_size_pips("fvg_high", "fvg_low", pip_factor)).select(*GAP_COLUMNS))


def gap_fill_future_in_blocks(silver: DataFrame, *, pip_factor: int | Column = DEFAULT_PIP_FACTOR,
                              block_bars: int = BLOCK_BARS) -> DataFrame:
    """``gap_fill_future`` with an instrument in many tasks."""
    marked = neighbour_bars_in_blocks(future_extremes_in_blocks(silver, block_bars), block_bars)
    marked = marked.withColumns(gap_levels("ordered")).where("fvg_type IS NOT NULL")
    filled = (F.when((F.col("fvg_type") == BULLISH) & (F.col("future_low") <= F.col("fvg_low")), 1)
              .when((F.col("fvg_type") == BEARISH) & (F.col("future_high") >= F.col("fvg_high")), 1).otherwise(0))
    return marked.withColumns({"fvg_size_pips": gap_size_pips("fvg_high", "fvg_low", pip_factor),
                               "is_filled": filled}).select(*GAP_COLUMNS, "is_filled")


# -- first fill ----------------------------------------------------------------

def _tree(placed: DataFrame, fanout: int, height: int) -> list[DataFrame]:
    """Runs of ``fanout`` siblings, level by level from the bars up: ``_run``, and their extremes in
    order of place, as arrays of at most ``fanout`` structs (at, low, high)."""
    levels, nodes = [], placed.select(*PAIR, F.col("_at").alias("_node"), F.col("low").alias("_low"),
                                      F.col("high").alias("_high"))
    for _ in range(height):
        run = F.floor(F.col("_node") / fanout).cast("long").alias("_run")
        levels.append(nodes.groupBy(*PAIR, run).agg(F.array_sort(F.collect_list(F.struct("_node", "_low", "_high")))
                                                    .alias("_nodes")))
        nodes = levels[-1].select(*PAIR, F.col("_run").alias("_node"), F.array_min("_nodes._low").alias("_low"),
                                  F.array_max("_nodes._high").alias("_high"))
    return levels


def _reached(node: Column) -> Column:
    """Whether a bar or a node holds one that fills the gap; NULL prices fill nothing."""
    return F.coalesce(F.when(F.col("fvg_type") == BULLISH, node["_low"] <= F.col("fvg_low"))
                      .otherwise(node["_high"] >= F.col("fvg_high")), F.lit(False))


def gap_first_fill_in_blocks(silver: DataFrame, *, pip_factor: int | Column = DEFAULT_PIP_FACTOR,
                             fanout: int = FANOUT, block_bars: int = BLOCK_BARS) -> DataFrame:
    """``gap_first_fill`` by a tree of block extremes, without a Python worker.

    Up: on each level a gap looks through the later siblings of the node it stands in (one array of
    at most ``fanout`` of them, met by an equi-join) and stops at the first that reaches its level.
    Down: from that node, on each level, to its first child that does. The tree's height comes
    from the longest instrument: one aggregate."""
    placed = with_places(silver, block_bars)
    longest = placed.agg(F.max("_at")).first()[0]
    height = 1
    while longest is not None and fanout ** height <= longest:
        height += 1
    levels = _tree(placed, fanout, height)
    neighbours = neighbour_bars_in_blocks(placed, block_bars).withColumns(gap_levels("ordered"))
    gaps = neighbours.where("fvg_type IS NOT NULL").select(
        *PAIR, "date", "_at", "fvg_type", "fvg_high", "fvg_low", "open", "high", "low", "close")

    found = gaps.withColumns({"_hit": F.lit(None).cast("long"), "_level": F.lit(None).cast("int")})
    for level in range(height):
        own = F.floor(F.col("_at") / fanout ** level).cast("long")
        asked = found.withColumn("_run", F.floor(own / fanout).cast("long"))
        met = _null_safe(asked, levels[level], [*PAIR, "_run"])
        later = F.filter("_nodes", lambda x: (x["_node"] > own) & _reached(x))
        hit = F.when(F.col("_hit").isNull(), F.get(later, F.lit(0))["_node"])
        found = met.withColumn("_new", hit).select(
            *gaps.columns, F.coalesce("_hit", "_new").alias("_hit"),
            F.when(F.col("_new").isNotNull(), F.lit(level)).otherwise(F.col("_level")).cast("int").alias("_level"))
    for level in range(height - 1, 0, -1):
        below = found.withColumn("_run", F.when(F.col("_level") == level, F.col("_hit")))
        met = _null_safe(below, levels[level - 1], [*PAIR, "_run"], "left")
        child = F.get(F.filter("_nodes", _reached), F.lit(0))["_node"]
        down = F.col("_level") == level
        found = met.withColumn("_new", child).select(
            *gaps.columns, F.when(down, F.col("_new")).otherwise(F.col("_hit")).alias("_hit"),
            F.when(down, F.lit(level - 1)).otherwise(F.col("_level")).cast("int").alias("_level"))
    days = placed.select(*PAIR, F.col("_at").alias("_hit"), F.col("date").alias("first_fill_date"))
    filled = _null_safe(found, days, [*PAIR, "_hit"], "left")
    return filled.select(
        "date", *PAIR, "fvg_type", "fvg_high", "fvg_low", gap_size_pips("fvg_high", "fvg_low", pip_factor).alias("fvg_size_pips"),
        "open", "high", "low", "close", F.col("first_fill_date").isNotNull().cast("int").alias("is_filled"),
        "first_fill_date", (F.col("_hit") - F.col("_at")).cast("int").alias("bars_to_fill"),
        F.datediff("first_fill_date", "date").alias("days_to_fill"))


__all__ = ["detect_gaps_in_blocks", "derive_fields_in_blocks", "future_extremes_in_blocks", "gap_fill_future_in_blocks",
           "gap_first_fill_in_blocks", "neighbour_bars_in_blocks", "rolling_volatility_in_blocks", "with_edges", "with_places"]
