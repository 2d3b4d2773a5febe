"""Column expressions shared by the operators.

Everything here is a built-in ``pyspark.sql.functions`` expression, so it
stays inside whole-stage codegen; nothing crosses into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

PRICE_TYPE = "decimal(10,5)"
PIPS_TYPE = "decimal(10,2)"

PAIR_KEYS = ("from_symbol", "to_symbol")
BAR_KEYS = ("date", "from_symbol", "to_symbol")
PRICE_COLUMNS = ("open", "high", "low", "close")

# One pip is 0.0001 of the quote currency for the pairs the
# gap sizes are reported for, so sizes are (high - low) * 10000.
DEFAULT_PIP_FACTOR = 10000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: How a pair key writes what would make two keys alike.
_PAIR_ESCAPES = (("%", "%25"), ("_", "%5F"))
_NO_SYMBOL = "%"


def pair_id(from_col: str | Column = "from_symbol", to_col: str | Column = "to_symbol") -> Column:
    """Key of one instrument, e.g. EUR_USD: one key for each pair of symbols, whatever their
    case. Inside a symbol an underscore is written %5F and a percent sign %25; a NULL symbol
    is a lone percent sign."""
    parts = []
    for c in (from_col, to_col):
        symbol = F.upper(col(c))
        for plain, escaped in _PAIR_ESCAPES:
            symbol = F.replace(symbol, F.lit(plain), F.lit(escaped))
        parts.append(F.coalesce(symbol, F.lit(_NO_SYMBOL)))
    return F.concat_ws("_", *parts)


def pair_symbols(pair: str | tuple[str, str]) -> tuple[str, str]:
    """The two symbols, in upper case, of ``("EUR", "USD")`` or its key ``"EUR_USD"``."""
    if isinstance(pair, str):
        parts = pair.split("_")
        if len(parts) != 2:
            raise ValueError(f"{pair!r} names no instrument: give ('EUR', 'USD') or 'EUR_USD'")
        for plain, escaped in reversed(_PAIR_ESCAPES):
            parts = [p.replace(escaped, plain).replace(escaped.lower(), plain) for p in parts]
    else:
        parts = list(pair)
        if len(parts) != 2:
            raise ValueError(f"{pair!r} is no pair of symbols")
    return parts[0].upper(), parts[1].upper()


def to_price(c: str | Column) -> Column:
    """Lenient string/number -> decimal(10,5): malformed or overflowing -> NULL.

    Spark 4 runs ANSI casts by default, where a plain ``cast`` throws on bad
    input; ``try_cast`` keeps the NULL-then-drop behaviour of the silver layer.
    """
    return col(c).try_cast(PRICE_TYPE)


def pair_window(*order: str | Column) -> WindowSpec:
    """One instrument's bars in date order (the frame of every lag/lead)."""
    return Window.partitionBy(*PAIR_KEYS).orderBy(*(order or ("date",)))


def gap_size_pips(high: str | Column, low: str | Column,
                  pip_factor: int | Column = DEFAULT_PIP_FACTOR) -> Column:
    """(high - low) in pips as decimal(10,2); NULL when it does not fit.

    ``pip_factor`` is a number, or a column for per-instrument pip sizes
    (e.g. ``quote_pip_factor()``).
    """
    factor = pip_factor if isinstance(pip_factor, Column) else F.lit(pip_factor)
    return ((col(high) - col(low)) * factor).try_cast(PIPS_TYPE)


# Quote currencies whose pip is 0.01 rather than 0.0001.
HUNDREDTH_PIP_QUOTES = ("JPY",)


def quote_pip_factor(to_col: str = "to_symbol") -> Column:
    """Per-row pip factor: 100 for quotes in ``HUNDREDTH_PIP_QUOTES``, else 10000."""
    return F.when(F.upper(F.col(to_col)).isin(list(HUNDREDTH_PIP_QUOTES)), F.lit(100)) \
        .otherwise(F.lit(DEFAULT_PIP_FACTOR))


def timestamp_literal(ts: str | None) -> Column:
    """An ISO-8601 instant as a TIMESTAMP literal (session time zone applies
    to values without an offset); folded to a constant by Catalyst. ``None``
    means "now": ``current_timestamp()``, one value per query execution."""
    if ts is None:
        return F.current_timestamp()
    return F.lit(ts).cast("timestamp")
