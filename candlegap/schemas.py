"""Layer schemas as they are really written, and ``conform``.

Bronze keeps every field as text (prices and date are parsed in silver);
silver and gold carry the typed columns in their physical order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PRICE = DecimalType(10, 5)
PIPS = DecimalType(10, 2)

BRONZE_SCHEMA = StructType([
    StructField("date", StringType(), True),
    StructField("open", StringType(), True),
    StructField("high", StringType(), True),
    StructField("low", StringType(), True),
    StructField("close", StringType(), True),
    StructField("from_symbol", StringType(), True),
    StructField("to_symbol", StringType(), True),
    # declared NOT NULL; file readers relax it and bronze re-stamps it anyway
    StructField("_ingest_timestamp", TimestampType(), False),
    StructField("_source", StringType(), True),
])

SILVER_SCHEMA = StructType([
    StructField("date", DateType(), False),
    StructField("open", PRICE, False),
    StructField("high", PRICE, False),
    StructField("low", PRICE, False),
    StructField("close", PRICE, False),
    StructField("from_symbol", StringType(), False),
    StructField("to_symbol", StringType(), False),
    StructField("_ingest_timestamp", TimestampType(), True),
    StructField("_source", StringType(), True),
    StructField("daily_range", PRICE, False),
    StructField("daily_return", PRICE, True),
])

GOLD_SCHEMA = StructType([
    StructField("date", DateType(), False),
    StructField("from_symbol", StringType(), False),
    StructField("to_symbol", StringType(), False),
    StructField("fvg_type", StringType(), False),
    StructField("fvg_high", PRICE, False),
    StructField("fvg_low", PRICE, False),
    StructField("fvg_size_pips", PIPS, True),
    StructField("open", PRICE, False),
    StructField("high", PRICE, False),
    StructField("low", PRICE, False),
    StructField("close", PRICE, False),
    StructField("is_filled", IntegerType(), False),
    StructField("_updated_at", TimestampType(), True),
])

LAYERS: dict[str, StructType] = {
    "bronze": BRONZE_SCHEMA,
    "silver": SILVER_SCHEMA,
    "gold": GOLD_SCHEMA,
}


def _cast(name: str, dtype: DataType) -> Column:
    # try_cast: a value that does not fit becomes NULL and is then reported by
    # null_violations instead of failing the whole job under ANSI mode.
    return F.col(name).try_cast(dtype).alias(name)


def conform(df: DataFrame, schema: StructType | str, *, keep_extra: bool = False) -> DataFrame:
    """Select the schema's columns in its order and cast them to its types.

    Columns the schema lacks are dropped unless ``keep_extra`` (then they
    follow, e.g. the ``pair`` partition column). A column the frame lacks is
    added as a typed NULL, which is how an older batch meets a newer schema.
    One Project node; no action.
    """
    if isinstance(schema, str):
        schema = LAYERS[schema]
    have = [(f.name, f.dataType) for f in df.schema.fields]
    if have == [(f.name, f.dataType) for f in schema.fields]:
        return df  # already conforming: no extra Project to analyse
    present = set(df.columns)
    cols = [
        _cast(f.name, f.dataType) if f.name in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    if keep_extra:
        names = set(schema.fieldNames())
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)


def null_violations(df: DataFrame, schema: StructType | str) -> DataFrame:
    """One row: per NOT NULL column of ``schema``, how many rows are NULL.

    A single global aggregate (partial per task, one row shuffled per task),
    so it can run beside a write via ``DataFrame.observe`` as well.
    """
    if isinstance(schema, str):
        schema = LAYERS[schema]
    checks = [
        F.count_if(F.col(f.name).isNull()).alias(f"null_{f.name}")
        for f in schema.fields if not f.nullable and f.name in df.columns
    ]
    return df.agg(*checks)


def broken_not_null(schema: StructType | str, columns: Iterable[str] | None = None) -> Column:
    """``null_<column>`` of the first NOT NULL column of ``schema`` (of those in ``columns``) that a
    row has no value in; NULL for a row that may be stored."""
    if isinstance(schema, str):
        schema = LAYERS[schema]
    names = [f.name for f in schema.fields if not f.nullable and (columns is None or f.name in columns)]
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in names], F.lit(None).cast("string"))
