"""Readers for the raw zone and the partitioned layer tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from candlegap.sinks import layout
from candlegap.sinks.layout import Pair
from candlegap.schemas import BRONZE_SCHEMA


def scan_raw_json(
    spark: SparkSession,
    root: str,
    *,
    schema: StructType = BRONZE_SCHEMA,
    multi_line: bool = False,
    pairs: Iterable[Pair] | None = None,
) -> DataFrame:
    """Raw records with an enforced schema (no inference pass) and their key ``pair``.

    Fields absent from a record are NULL, numbers given where text is
    declared are kept as text. ``multi_line=True`` reads files that each
    hold one JSON array of records; such files cannot be split, so prefer
    JSON lines (the default) for large raw zones. ``pairs`` reads only the buckets of these
    instruments. Zones in other folders (``pair=...``) are read as well, without pruning.
    """
    # no timestampFormat: Spark's default parser reads any ISO-8601 instant,
    # with or without fractional seconds (as Python's isoformat writes them)
    df = (spark.read.schema(schema)
          .option("multiLine", str(multi_line).lower())
          .json(root))
    df = layout.laid_out(layout.with_pair(df if "pair" in schema.fieldNames() else df.drop("pair")))
    n = layout.stored_buckets(spark, root) if pairs is not None else None
    return layout.without_layout(layout.select_pairs(df, pairs, n))


def scan_partitions(
    spark: SparkSession,
    root: str,
    *,
    fmt: str = "parquet",
    merge_schema: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """A layer table with its partition columns (``layout.PARTITIONS``)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema if "pair" in schema.fieldNames() else
                               StructType([*schema.fields]).add("pair", StringType()))
    if merge_schema and fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    return layout.laid_out(reader.load(root))


def scan_layer(
    spark: SparkSession,
    root: str,
    *,
    pairs: Iterable[Pair] | None = None,
    fmt: str = "parquet",
    merge_schema: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """A bronze/silver/gold table written by ``write_layer``.

    ``pairs``, each ``("EUR", "USD")`` or ``"EUR_USD"``, selects instruments: their buckets are
    literals, so Spark prunes the other folders when it plans, and within a bucket the filter on
    ``pair`` skips row groups. Other filters and column selections are pushed into the Parquet scan
    as well. ``merge_schema`` reconciles files written with different column sets (schema
    evolution); it costs a job that reads every file footer, so it is opt-in. ``schema`` reads just
    those columns from every file (and ``pair``), which needs no footer pass, ignores columns that
    later batches added, and reads a table without rows as one.
    """
    df = scan_partitions(spark, root, fmt=fmt, merge_schema=merge_schema, schema=schema)
    n = layout.stored_buckets(spark, root) if pairs is not None else None
    return layout.without_layout(layout.select_pairs(df, pairs, n))
