"""Silver-layer quality operators: cast, clean (with rejects), whitelist, dedup."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlegap.functions.columns import BAR_KEYS, PRICE_COLUMNS, to_price

# The currency codes the bar tables accept by default.
VALID_SYMBOLS = ("EUR", "USD", "GBP", "NOK", "JPY", "CHF")

REQUIRED_COLUMNS = ("date",) + PRICE_COLUMNS


def cast_bars(bronze: DataFrame) -> DataFrame:
    """Text prices -> decimal(10,5), text date -> date; malformed -> NULL.

    Columns keep their place; anything else (stamp, source, a ``pair``
    partition column) passes through. One Project.
    """
    casts = {c: to_price(c) for c in PRICE_COLUMNS}
    casts["date"] = F.col("date").try_cast("date")
    return bronze.withColumns(casts)


def reject_reason(df: DataFrame | None = None) -> Column:
    """The first rule a typed bar breaks, or NULL for a good bar.

    Rules in the order the silver layer applies them: a NULL date or price,
    ``high < low``, a price that is zero or negative.
    """
    reason = F.lit(None).cast("string")
    for c in reversed(PRICE_COLUMNS):
        reason = F.when(F.col(c) <= 0, F.lit(f"non_positive_{c}")).otherwise(reason)
    reason = F.when(F.col("high") < F.col("low"), F.lit("high_below_low")).otherwise(reason)
    for c in reversed(REQUIRED_COLUMNS):
        reason = F.when(F.col(c).isNull(), F.lit(f"missing_{c}")).otherwise(reason)
    return reason


def _good() -> Column:
    cond = F.col("high") >= F.col("low")
    for c in PRICE_COLUMNS:
        cond = cond & (F.col(c) > 0)
    for c in REQUIRED_COLUMNS:
        cond = cond & F.col(c).isNotNull()
    return cond


def clean_bars(typed: DataFrame) -> DataFrame:
    """Keep bars with date and all prices present, ``high >= low``, prices > 0.

    A plain conjunctive filter, so Catalyst can push the null checks and
    comparisons into a Parquet scan of an already-typed table.
    """
    return typed.filter(_good())


def rejected_bars(typed: DataFrame) -> DataFrame:
    """The bars ``clean_bars`` drops, with ``reject_reason`` (first failing rule).

    ``clean_bars(x)`` and ``rejected_bars(x)`` partition ``x``: every input
    row lands in exactly one of them.
    """
    return typed.withColumn("reject_reason", reject_reason()).filter(
        F.col("reject_reason").isNotNull())


def valid_symbols(df: DataFrame, symbols: Iterable[str] = VALID_SYMBOLS,
                  columns: Sequence[str] = ("from_symbol", "to_symbol")) -> DataFrame:
    """Keep rows whose symbol columns are all in ``symbols``.

    The list is a literal ``IN`` set (pushed into a Parquet scan as an
    ``In`` filter); it is a short, fixed list, never data-sized.
    """
    allowed = sorted(set(symbols))
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isin(allowed)
    return df.filter(cond)


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = BAR_KEYS,
    order: Sequence[str] = ("_ingest_timestamp",),
) -> DataFrame:
    """One row per ``keys``: the latest by ``order`` (descending, NULLs last).

    Ties in ``order`` are broken by the remaining columns, descending, so the
    survivor is deterministic (all bronze rows of one run share a stamp).

    Plan: a single aggregation ``max((order..., rest...))`` grouped by the key, so each
    column is held and shipped once. Its partial step runs before the shuffle, so a key with a huge
    number of copies is reduced to one row per task map-side -- no task ever
    holds a whole copy group, unlike a ``row_number`` window which must sort
    the full group in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    ordering = list(order) + [c for c in rest if c not in order]
    picked = F.max(F.struct(*ordering)).alias("_row")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                        for c in df.columns])
