from candlegap.functions.columns import (
    BAR_KEYS,
    DEFAULT_PIP_FACTOR,
    PAIR_KEYS,
    PIPS_TYPE,
    PRICE_COLUMNS,
    PRICE_TYPE,
    gap_size_pips,
    pair_id,
    pair_window,
    quote_pip_factor,
    timestamp_literal,
    to_price,
)

__all__ = [
    "BAR_KEYS", "DEFAULT_PIP_FACTOR", "PAIR_KEYS", "PIPS_TYPE", "PRICE_COLUMNS",
    "PRICE_TYPE", "gap_size_pips", "pair_id", "pair_window", "quote_pip_factor",
    "timestamp_literal",
    "to_price",
]
