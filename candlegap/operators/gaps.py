"""Three-bar price gaps ("fair value gaps") and whether/when they are filled.

A bar *i* of an instrument carries a **bullish** gap when ``high[i-1] <
low[i+1]`` (zone ``high[i-1]`` .. ``low[i+1]``) and a **bearish** gap when
``low[i-1] > high[i+1]`` (zone ``high[i+1]`` .. ``low[i-1]``). Bars adjacent in
date order are neighbours; missing days are not filled in. A bar cannot carry
both (that would need ``high < low`` on a neighbour), so detection is one
``CASE`` over one window instead of a union of two filtered copies.

Plan shape: one shuffle by instrument, one sort by date, one Window node
holding all four lag/lead columns; detection, sizing and the close-based fill
flag are a Project + Filter in the same stage.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from candlegap.functions.columns import (
    DEFAULT_PIP_FACTOR,
    PAIR_KEYS,
    gap_size_pips,
    pair_window,
)
from candlegap.schemas import PRICE

GAP_COLUMNS = ("date", "from_symbol", "to_symbol", "fvg_type", "fvg_high", "fvg_low",
               "fvg_size_pips", "open", "high", "low", "close")

BULLISH, BEARISH = "bullish", "bearish"
LEVEL_MODES = ("ordered", "positional")


def neighbour_bars(bars: DataFrame) -> DataFrame:
    """Add ``prev_high``, ``prev_low`` (previous bar) and ``next_high``,
    ``next_low`` (next bar) of the same instrument; NULL at the ends."""
    w = pair_window()
    return bars.withColumns({
        "prev_high": F.lag("high", 1).over(w),
        "prev_low": F.lag("low", 1).over(w),
        "next_high": F.lead("high", 1).over(w),
        "next_low": F.lead("low", 1).over(w),
    })


def _is_bullish() -> Column:
    return F.col("prev_high") < F.col("next_low")


def _is_bearish() -> Column:
    return F.col("prev_low") > F.col("next_high")


def gap_levels(levels: str = "ordered") -> dict[str, Column]:
    """``fvg_type``, ``fvg_high``, ``fvg_low`` over neighbour columns.

    ``ordered``: ``fvg_high`` is the top of the zone, ``fvg_low`` the bottom,
    so sizes are >= 0 for both kinds. ``positional`` keeps the bearish levels
    the other way round (``fvg_high`` = next high, ``fvg_low`` = previous low,
    negative size), which is what a positional union of differently ordered
    bullish/bearish projections produces.
    """
    if levels not in LEVEL_MODES:
        raise ValueError(f"levels must be one of {LEVEL_MODES}, not {levels!r}")
    bull, bear = _is_bullish(), _is_bearish()
    kind = F.when(bull, F.lit(BULLISH)).when(bear, F.lit(BEARISH))
    if levels == "ordered":
        top = F.when(bull, F.col("next_low")).when(bear, F.col("prev_low"))
        bottom = F.when(bull, F.col("prev_high")).when(bear, F.col("next_high"))
    else:
        top = F.when(bull, F.col("next_low")).when(bear, F.col("next_high"))
        bottom = F.when(bull, F.col("prev_high")).when(bear, F.col("prev_low"))
    return {"fvg_type": kind, "fvg_high": top, "fvg_low": bottom}


def detect_gaps(
    silver: DataFrame,
    *,
    levels: str = "ordered",
    kinds: Sequence[str] = (BULLISH, BEARISH),
    pip_factor: int | Column = DEFAULT_PIP_FACTOR,
) -> DataFrame:
    """Gap rows, dated by the middle bar, in the gold column layout:
    date, from_symbol, to_symbol, fvg_type, fvg_high, fvg_low,
    fvg_size_pips, open, high, low, close."""
    out = neighbour_bars(silver)
    lv = gap_levels(levels)
    cond = lv["fvg_type"].isNotNull()
    kinds = tuple(kinds)
    if set(kinds) != {BULLISH, BEARISH}:
        cond = lv["fvg_type"].isin(list(kinds))
    out = out.filter(cond).select(
        "date", *PAIR_KEYS, lv["fvg_type"].alias("fvg_type"), lv["fvg_high"].alias("fvg_high"),
        lv["fvg_low"].alias("fvg_low"),
        gap_size_pips(lv["fvg_high"], lv["fvg_low"], pip_factor).alias("fvg_size_pips"),
        "open", "high", "low", "close")
    return out


def detect_gaps_inline(bars: DataFrame, *, levels: str = "ordered",
                       pip_factor: int | Column = DEFAULT_PIP_FACTOR) -> DataFrame:
    """Every bar, with ``fvg_type`` / ``fvg_high`` / ``fvg_low`` /
    ``fvg_size_pips`` set on the bars that carry a gap (NULL elsewhere).

    For reports that need bars and gaps side by side: same single window as
    ``detect_gaps``, no filter, so no join back to the bars.
    """
    out = neighbour_bars(bars).withColumns(gap_levels(levels))
    out = out.withColumn("fvg_size_pips", gap_size_pips("fvg_high", "fvg_low", pip_factor))
    return out.drop("prev_high", "prev_low", "next_high", "next_low")


def detect_bullish(silver: DataFrame, **kw) -> DataFrame:
    return detect_gaps(silver, kinds=(BULLISH,), **kw)


def detect_bearish(silver: DataFrame, **kw) -> DataFrame:
    return detect_gaps(silver, kinds=(BEARISH,), **kw)


def detect_gaps_union(silver: DataFrame, *, levels: str = "ordered",
                      pip_factor: int | Column = DEFAULT_PIP_FACTOR) -> DataFrame:
    """Bullish and bearish rows detected separately and unioned by name.

    Kept to check that the single-pass ``detect_gaps`` returns the same rows;
    it costs a second Window over the same exchange, so prefer ``detect_gaps``.
    """
    return detect_bullish(silver, levels=levels, pip_factor=pip_factor).unionByName(
        detect_bearish(silver, levels=levels, pip_factor=pip_factor))


def gap_fill_close(gaps: DataFrame) -> DataFrame:
    """``is_filled`` (int 0/1) from the gap bar's own close: bullish when
    ``close <= fvg_high``, bearish when ``close >= fvg_low``.

    With positional levels the bearish test compares against the zone top
    (the previous low); with ordered levels against the bottom.
    """
    filled = (
        F.when((F.col("fvg_type") == BULLISH) & (F.col("close") <= F.col("fvg_high")), F.lit(1))
        .when((F.col("fvg_type") == BEARISH) & (F.col("close") >= F.col("fvg_low")), F.lit(1))
        .otherwise(F.lit(0))
    )
    return gaps.withColumn("is_filled", filled)


def _future_extremes(silver: DataFrame) -> DataFrame:
    """``future_low`` / ``future_high``: min(low) / max(high) over the bars
    after each bar of the same instrument (NULL on the last bar).

    Written as a growing frame over the reversed order (``unboundedPreceding
    .. -1`` by date descending): Spark evaluates that in one pass, while the
    equivalent shrinking frame ``1 .. unboundedFollowing`` is recomputed per
    row (quadratic in the instrument's bar count). Same partitioning as the
    neighbour window, so it adds a sort, not a shuffle.
    """
    w = (Window.partitionBy(*PAIR_KEYS).orderBy(F.col("date").desc())
         .rowsBetween(Window.unboundedPreceding, -1))
    return silver.withColumns({
        "future_low": F.min("low").over(w),
        "future_high": F.max("high").over(w),
    })


def gap_fill_future(silver: DataFrame, *,
                    pip_factor: int | Column = DEFAULT_PIP_FACTOR) -> DataFrame:
    """Gaps (ordered levels) with ``is_filled`` decided by the later bars:
    bullish when a later low reaches ``fvg_low``, bearish when a later high
    reaches ``fvg_high``, i.e. price traded through the whole zone."""
    lv = gap_levels("ordered")
    nb = neighbour_bars(_future_extremes(silver)).withColumns(lv).filter(
        F.col("fvg_type").isNotNull())
    filled = (
        F.when((F.col("fvg_type") == BULLISH) & (F.col("future_low") <= F.col("fvg_low")),
               F.lit(1))
        .when((F.col("fvg_type") == BEARISH) & (F.col("future_high") >= F.col("fvg_high")),
              F.lit(1))
        .otherwise(F.lit(0))
    )
    return nb.withColumns({
        "fvg_size_pips": gap_size_pips("fvg_high", "fvg_low", pip_factor),
        "is_filled": filled,
    }).select(*GAP_COLUMNS, "is_filled")


# -- first fill -----------------------------------------------------------

_UNITS = 100000  # decimal(10,5) prices as exact integers
_UNIT = "0.00001"

FIRST_FILL_SCHEMA = StructType([
    StructField("from_symbol", StringType(), True),
    StructField("to_symbol", StringType(), True),
    StructField("date", DateType(), True),
    StructField("fvg_type", StringType(), True),
    StructField("fvg_high_u", LongType(), True),
    StructField("fvg_low_u", LongType(), True),
    StructField("open_u", LongType(), True),
    StructField("high_u", LongType(), True),
    StructField("low_u", LongType(), True),
    StructField("close_u", LongType(), True),
    StructField("first_fill_date", DateType(), True),
    StructField("bars_to_fill", IntegerType(), True),
])


def _first_at_or_below(values: np.ndarray, start: np.ndarray, level: np.ndarray,
                       end: np.ndarray) -> np.ndarray:
    """For each query q: the smallest j in [start[q], end[q]) with
    values[j] <= level[q], or end[q] if there is none.

    Sparse table of range minima plus binary lifting, vectorised over all
    queries of a batch: O((n + q) log n) for n bars and q gaps.
    """
    n = len(values)
    pos = start.astype(np.int64)
    if n == 0 or len(pos) == 0:
        return end.astype(np.int64)
    tables = [values]
    span = 1
    while span * 2 <= n:
        prev = tables[-1]
        tables.append(np.minimum(prev[: len(prev) - span], prev[span:]))
        span *= 2
    for k in range(len(tables) - 1, -1, -1):
        width = 1 << k
        tab = tables[k]  # tab[p] = min(values[p : p + width])
        fits = pos + width <= end
        probe = tab[np.where(fits, pos, 0)]
        pos = np.where(fits & (probe > level), pos + width, pos)
    return pos


_OUT_COLUMNS = [f.name for f in FIRST_FILL_SCHEMA.fields]


def _solve_first_fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows of whole instruments, each instrument's bars contiguous and in
    date order -> the gap rows with their first fill."""
    n = len(pdf)
    fs, ts = pdf["from_symbol"].to_numpy(dtype=object), pdf["to_symbol"].to_numpy(dtype=object)
    new_seg = np.ones(n, dtype=bool)
    new_seg[1:] = (fs[1:] != fs[:-1]) | (ts[1:] != ts[:-1])
    seg_start = np.flatnonzero(new_seg)
    seg_end = np.append(seg_start[1:], n)
    row_end = np.repeat(seg_end, np.diff(np.append(seg_start, n)))
    gap_idx = np.flatnonzero(pdf["fvg_type"].notna().to_numpy())
    gaps = pdf.iloc[gap_idx]
    bull = (gaps["fvg_type"] == BULLISH).to_numpy()
    start, end = gap_idx + 1, row_end[gap_idx]
    found = end.copy()
    # bullish: first later low <= fvg_low; bearish: first later high >= fvg_high,
    # searched as -high <= -fvg_high. Integer price units: exact comparisons.
    # A NULL price fills nothing and does not end the search.
    lows, highs = (pdf[c].to_numpy(dtype=np.float64, na_value=np.nan) for c in ("low_u", "high_u"))
    if bull.any():
        found[bull] = _first_at_or_below(
            np.where(np.isnan(lows), np.inf, lows), start[bull],
            gaps["fvg_low_u"].to_numpy(dtype=np.float64)[bull], end[bull])
    if (~bull).any():
        found[~bull] = _first_at_or_below(
            np.where(np.isnan(highs), np.inf, -highs), start[~bull],
            -gaps["fvg_high_u"].to_numpy(dtype=np.float64)[~bull], end[~bull])
    filled = found < end
    dates = pdf["date"].to_numpy(dtype=object)
    out = gaps[_OUT_COLUMNS[:10]].reset_index(drop=True)
    out["first_fill_date"] = np.where(filled, dates[np.minimum(found, n - 1)], None)
    steps = pd.array(found - gap_idx, dtype="Int32")
    steps[~filled] = pd.NA
    out["bars_to_fill"] = steps
    return out


def _first_fill_stream(batches):
    """Arrow batches of one partition, clustered by instrument and sorted by
    date -> gap rows. Pieces of an instrument cut by batch boundaries are kept
    until it ends and joined once, so memory stays at one batch plus one instrument."""
    pieces, name = [], None
    for pdf in batches:
        if pdf.empty:
            continue
        names = list(zip(pdf["from_symbol"], pdf["to_symbol"], strict=True))
        last = names[-1]
        cut = next((i for i in range(len(names) - 1, -1, -1) if names[i] != last), -1) + 1
        if pieces and (cut > 0 or last != name):
            pieces.append(pdf.iloc[:cut])
            yield _solve_first_fill(pd.concat(pieces, ignore_index=True))
            pieces = []
        elif cut > 0:
            yield _solve_first_fill(pdf.iloc[:cut].reset_index(drop=True))
        pieces.append(pdf.iloc[cut:])
        name = last
    if pieces:
        yield _solve_first_fill(pd.concat(pieces, ignore_index=True))


def _from_units(name: str) -> Column:
    return (F.col(f"{name}_u").cast("decimal(18,0)") * F.lit(_UNIT).cast("decimal(5,5)")
            ).cast(PRICE).alias(name)


def gap_first_fill(silver: DataFrame, *,
                   pip_factor: int | Column = DEFAULT_PIP_FACTOR) -> DataFrame:
    """Gaps (ordered levels) with the first later bar that fills them:
    ``is_filled`` (as ``gap_fill_future``), ``first_fill_date``,
    ``bars_to_fill`` and ``days_to_fill`` (NULL while the gap is open).

    "First later bar whose low reaches a per-gap level" is not a window
    aggregate, and the equivalent range join (pair equal, later date, level
    predicate) emits every later filling bar per gap -- quadratic within an
    instrument. So the search runs in ``mapInPandas`` right after the
    neighbour window, whose output is already hash-partitioned by instrument
    and date-ordered: no extra shuffle, and each Arrow batch solves all the
    instruments it holds in one vectorised sparse-table binary search
    (exact, O(n log n)). Precondition: (pair, date) is unique, as after ``dedup_latest``.
    Memory is one batch plus one instrument's
    deduplicated daily bars (bounded by the calendar). Only integer price
    units and dates cross into Python; decimals are rebuilt JVM-side.
    """
    marked = neighbour_bars(silver).withColumns(gap_levels("ordered"))
    units = {f"{c}_u": (F.col(c) * _UNITS).cast("long")
             for c in ("open", "high", "low", "close", "fvg_high", "fvg_low")}
    narrow = marked.select(*PAIR_KEYS, "date", "fvg_type",
                           *[e.alias(k) for k, e in units.items()])
    # The Window above hash-partitions by instrument and sorts by (instrument,
    # date); this sort restates that order and is removed by the planner as
    # redundant, so mapInPandas sees whole, ordered instruments per partition.
    fills = narrow.sortWithinPartitions(*PAIR_KEYS, "date").mapInPandas(
        _first_fill_stream, FIRST_FILL_SCHEMA)
    prices = [_from_units(c) for c in ("fvg_high", "fvg_low", "open", "high", "low", "close")]
    out = fills.select("date", *PAIR_KEYS, "fvg_type", "first_fill_date", "bars_to_fill", *prices)
    return out.select(
        "date", *PAIR_KEYS, "fvg_type", "fvg_high", "fvg_low",
        gap_size_pips("fvg_high", "fvg_low", pip_factor).alias("fvg_size_pips"),
        "open", "high", "low", "close",
        F.col("first_fill_date").isNotNull().cast("int").alias("is_filled"),
        "first_fill_date", "bars_to_fill",
        F.datediff("first_fill_date", "date").alias("days_to_fill"),
    )


__all__ = [
    "BEARISH", "BULLISH", "GAP_COLUMNS", "LEVEL_MODES", "detect_bearish",
    "detect_bullish", "detect_gaps", "detect_gaps_inline", "detect_gaps_union", "gap_fill_close",
    "gap_fill_future",
    "gap_first_fill", "gap_levels", "neighbour_bars",
]
