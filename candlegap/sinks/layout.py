"""How layer tables lie in storage: hash buckets of instruments, by month.

    <root>/n_buckets=64/bucket=17/month=202401/part-....parquet

``bucket`` is ``pmod(xxhash64(from, to), n_buckets)`` of the upper-case symbols and ``month`` is
``yyyymm`` of the date (0 without a valid one). The number of buckets is fixed when a table is
first written and is part of its paths, so every later reader and writer finds it there. Folders
grow with buckets x months and not with instruments; rows of a file are in (pair, date) order, so
Parquet statistics on ``pair`` skip row groups within a bucket.

Selecting an instrument is a literal filter on ``bucket`` (Catalyst folds the hash of its
symbols), and a batch touches the partitions of its own (bucket, month) pairs only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlegap.functions.columns import pair_id, pair_symbols
from candlegap.sinks.paths import child_folders

DEFAULT_BUCKETS = 64
COUNT, BUCKET, MONTH = "n_buckets", "bucket", "month"
PARTITIONS = (COUNT, BUCKET, MONTH)

Pair = str | tuple[str, str]


def bucket_of(n_buckets: int, from_symbol: Column, to_symbol: Column) -> Column:
    """The bucket of an instrument; a literal where the symbols are."""
    return F.pmod(F.xxhash64(F.upper(from_symbol), F.upper(to_symbol)), F.lit(n_buckets).cast("long")).cast("int")


def month_of(date: Column) -> Column:
    """``yyyymm`` of a date or its text; 0 where it is no date."""
    day = date.try_cast("date")
    return F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0)).cast("int")


def with_pair(df: DataFrame) -> DataFrame:
    """``df`` with the instrument key ``pair`` (``pair_id``), if missing."""
    return df if "pair" in df.columns else df.withColumn("pair", pair_id())


def with_layout(df: DataFrame, n_buckets: int) -> DataFrame:
    """``df`` with its partition columns. Tables without a ``date`` lie in month 0."""
    month = month_of(F.col("date")) if "date" in df.columns else F.lit(0)
    return df.withColumns({COUNT: F.lit(n_buckets), MONTH: month,
                           BUCKET: bucket_of(n_buckets, F.col("from_symbol"), F.col("to_symbol"))})


def clustered(df: DataFrame) -> DataFrame:
    """Rows of a partition together and in (pair, date) order: few files a task, and adaptive
    execution splits what is too much for one writer and joins what is little."""
    order = [c for c in ("from_symbol", "to_symbol", "date") if c in df.columns]
    return df.hint("rebalance", BUCKET, MONTH).sortWithinPartitions(*PARTITIONS, *order)


def stored_buckets(spark: SparkSession, root: str) -> int | None:
    """The number of buckets of the table under ``root``; None where there is none yet."""
    counts = {int(name.split("=")[1]) for name in child_folders(spark, root) if name.startswith(f"{COUNT}=")}
    if len(counts) > 1:
        raise ValueError(f"{root} holds layouts of {sorted(counts)} buckets")
    return counts.pop() if counts else None


def is_laid_out(df: DataFrame) -> bool:
    return set(PARTITIONS) <= set(df.columns)


def laid_out(df: DataFrame) -> DataFrame:
    """``df`` with partition columns, which Spark does not find in a table without files."""
    return df if is_laid_out(df) else df.withColumns({c: F.lit(None).cast("int") for c in PARTITIONS})


def without_layout(df: DataFrame) -> DataFrame:
    return df.drop(*PARTITIONS)


def select_pairs(df: DataFrame, pairs: Iterable[Pair] | None, n_buckets: int | None) -> DataFrame:
    """Rows of ``pairs``, each ``("EUR", "USD")`` or ``"EUR_USD"`` in any case: a literal filter on
    the bucket, which prunes folders, and one on ``pair``, which skips row groups."""
    if pairs is None:
        return df
    symbols = sorted({pair_symbols(p) for p in pairs})
    if not symbols:
        return df.where(F.lit(False))
    wanted = [pair_id(F.lit(a), F.lit(b)) for a, b in symbols]
    out = df.where(F.col("pair").isin(wanted))
    if n_buckets is not None and is_laid_out(df):
        buckets = [bucket_of(n_buckets, F.lit(a), F.lit(b)) for a, b in symbols]
        out = out.where(F.col(BUCKET).isin(buckets))
    return out


def touched_partitions(laid_out: DataFrame) -> list[tuple[int, int]]:
    """The (bucket, month) pairs that hold rows of a frame: at most buckets x months."""
    rows = laid_out.select(BUCKET, MONTH).distinct().collect()
    return sorted((r[BUCKET], r[MONTH]) for r in rows)


def in_partitions(df: DataFrame, parts: Iterable[tuple[int, int]]) -> DataFrame:
    """Rows of these partitions: literal filters, one for the months of each set of buckets that
    share them, so that nothing else is listed or read."""
    months: dict[int, set[int]] = {}
    for bucket, month in parts:
        months.setdefault(bucket, set()).add(month)
    alike: dict[tuple[int, ...], list[int]] = {}
    for bucket, held in sorted(months.items()):
        alike.setdefault(tuple(sorted(held)), []).append(bucket)
    keep = F.lit(False)
    for held, buckets in alike.items():
        keep = keep | (F.col(BUCKET).isin(buckets) & F.col(MONTH).isin(list(held)))
    return df.where(keep)
