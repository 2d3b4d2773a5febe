"""Global order as a column, and global top-k with ties, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlegap.sinks.paths import scratch_path


def with_positions(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) in the global ``order``.

    A range exchange and a sort inside each partition give the order; it is written once with
    running numbers per partition, and the partitions' counts, summed up over one row a
    partition, shift these to global places. The order should be total: rows that tie take
    places next to one another, as they were met.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "positions")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    schema = df.withColumn("_at", F.lit(0).cast("long")).schema
    rows = spark.read.schema(schema).parquet(path).withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy("_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    shifts = parts.select("_part", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return rows.join(shifts, "_part").select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def top_with_ties(df: DataFrame, value: Column, top: int, *, name: str = "rank") -> DataFrame:
    """The rows whose ``rank()`` by ``value`` descending (NULLs last) is at most ``top``, with it.

    First pass: the ``top`` largest values, each task keeping its own (``TakeOrdered``); ``top``
    numbers reach the driver. Their places are the ranks: rows that tie have the place of the first
    of them. Second pass: a filter by the least of these values and a join with these at most
    ``top`` numbers. Rows that tie at the end, or have NULL where there are fewer values than
    ``top``, stay in the tasks that read them, however many they are.
    """
    keyed = df.withColumn("_value", value)
    largest = [r[0] for r in keyed.select("_value").orderBy(F.col("_value").desc_nulls_last()).limit(top).collect()]
    ranks: dict = {}
    for place, v in enumerate(largest, 1):
        ranks.setdefault(v, place)
    null_rank = ranks.pop(None, None)
    kind = keyed.schema["_value"].dataType.simpleString()
    known = df.sparkSession.createDataFrame(list(ranks.items()), f"_known {kind}, _rank int")
    inside = F.lit(False) if not ranks else F.col("_value") >= F.lit(min(ranks)).cast(kind)
    if null_rank is not None:
        inside = inside | F.col("_value").isNull()
    rank = F.coalesce("_rank", F.lit(null_rank).cast("int"))
    return (keyed.where(inside).join(F.broadcast(known), F.col("_value") == F.col("_known"), "left")  # ``top`` rows
            .select(*df.columns, rank.alias(name)))
