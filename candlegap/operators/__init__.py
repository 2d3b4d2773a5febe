"""DataFrame -> DataFrame operators of the bar, silver and gold layers."""

from candlegap.operators.blocks import (
    derive_fields_in_blocks,
    detect_gaps_in_blocks,
    future_extremes_in_blocks,
    gap_fill_future_in_blocks,
    gap_first_fill_in_blocks,
    neighbour_bars_in_blocks,
    rolling_volatility_in_blocks,
)
from candlegap.operators.enrich import daily_range, daily_return, derive_fields, rolling_volatility
from candlegap.operators.gaps import (
    detect_bearish,
    detect_bullish,
    detect_gaps,
    detect_gaps_union,
    gap_fill_close,
    gap_fill_future,
    gap_first_fill,
    neighbour_bars,
)
from candlegap.operators.merge import evolve_schema, upsert_bars
from candlegap.operators.quality import (
    VALID_SYMBOLS,
    cast_bars,
    clean_bars,
    dedup_latest,
    reject_reason,
    rejected_bars,
    valid_symbols,
)

__all__ = [
    "VALID_SYMBOLS", "cast_bars", "clean_bars", "daily_range", "daily_return", "dedup_latest",
    "derive_fields", "detect_bearish", "detect_bullish", "detect_gaps", "detect_gaps_union",
    "evolve_schema", "gap_fill_close", "gap_fill_future", "gap_first_fill", "neighbour_bars",
    "reject_reason", "rejected_bars", "rolling_volatility", "upsert_bars", "valid_symbols",
]
