"""Writers for the raw zone (JSON) and the bar/gap layers (Parquet)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlegap.sinks import layout
from candlegap.sinks.layout import BUCKET, COUNT, DEFAULT_BUCKETS, MONTH, PARTITIONS, with_pair
from candlegap.sinks.paths import remove, scratch_path

# Microseconds survive the text round trip (Spark's default JSON timestamp
# format keeps milliseconds only).
JSON_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def observed(seen: Observation, rows: DataFrame) -> dict:
    """What was observed while a write ran; asked of ``rows`` where adaptive execution cut the
    observing part out of the plan, which it does when a stage before it gave no rows."""
    try:
        return seen.get
    except (AssertionError, Py4JJavaError):
        return rows.first().asDict()


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` computed once for several uses: written to a scratch folder, which goes at the end.

    A persisted frame keeps every shuffle partition, as adaptive execution joins none of them in a
    cached plan: each use of a few rows then runs that many tasks, and each exchange after it
    writes up to that number squared of blocks. Files are as many as the rows ask for, and their
    size tells which side of a join is small.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def _save(df: DataFrame, root: str, *, mode: str, fmt: str, n_buckets: int,
          whole_table: bool = False) -> set[tuple[int, int]]:
    """``df`` as (bucket, month) partitions: those it carries, or all there are. Returns which it
    carried, as observed while they were written (at most buckets x months)."""
    seen = Observation("partitions")
    rows, parts = layout.with_layout(df, n_buckets), F.collect_set(F.struct(BUCKET, MONTH)).alias("parts")
    (layout.clustered(rows.observe(seen, parts)).write.format(fmt).mode(mode)
     .option("partitionOverwriteMode", "static" if whole_table else "dynamic")
     .option("timestampFormat", JSON_TIMESTAMP_FORMAT)
     .partitionBy(*PARTITIONS).save(root))
    return {(r[BUCKET], r[MONTH]) for r in observed(seen, rows.agg(parts))["parts"]}


def _read(spark: SparkSession, root: str, fmt: str, like: DataFrame) -> DataFrame:
    """A laid-out table with all columns that any batch brought (Parquet), or those of ``like``."""
    reader = spark.read.format(fmt)
    reader = reader.option("mergeSchema", "true") if fmt == "parquet" else reader.schema(like.schema)
    try:
        return layout.laid_out(reader.load(root))
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # all rows had gone
            raise
        return layout.laid_out(spark.createDataFrame([], like.schema))


def replace_partitions(df: DataFrame, root: str, owned: Iterable[tuple[int, int]], *, fmt: str = "parquet",
                       n_buckets: int) -> set[tuple[int, int]]:
    """``df`` becomes the whole content of the partitions ``owned``, all others stay. One write:
    Spark moves the new partitions into place when all of them are complete, so ``df`` may read the
    old ones and a failed run leaves them as they were. Then those without new rows go.
    Returns the partitions that got rows."""
    kept = _save(df, root, mode="overwrite", fmt=fmt, n_buckets=n_buckets)
    for bucket, month in sorted(set(owned) - kept):
        remove(df.sparkSession, f"{root.rstrip('/')}/{COUNT}={n_buckets}/{BUCKET}={bucket}/{MONTH}={month}")
    return kept


def write_layer(
    df: DataFrame,
    root: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    cluster_by: Sequence[str] = ("pair",),
    fmt: str = "parquet",
    whole_table: bool = False,
    buckets: int = DEFAULT_BUCKETS,
) -> None:
    """Bronze/silver/gold table under ``root``, laid out by ``layout`` with the key ``pair``
    stored in its rows.

    ``mode="overwrite"`` replaces the instruments that ``df`` carries (``replace_pairs``), or with
    ``whole_table=True`` everything, so that instruments without rows keep none;
    ``mode="append"`` adds rows. ``buckets`` counts for a table's first or whole write; later
    ones keep the number it has.

    ``partition_by`` (``()`` for a single folder) writes a plain table by those columns instead:
    rebalanced by ``cluster_by`` and sorted by it (and date) within each file.
    """
    df = with_pair(df)
    if partition_by is not None:
        keys = list(partition_by) or list(cluster_by)
        out = df.hint("rebalance", *keys) if keys else df
        if not partition_by and cluster_by:
            out = out.sortWithinPartitions(*cluster_by, *(["date"] if "date" in out.columns else []))
        (out.write.format(fmt).mode(mode)
         .option("partitionOverwriteMode", "static" if whole_table else "dynamic")
         .partitionBy(*partition_by).save(root))
    elif whole_table:
        _save(df, root, mode=mode, fmt=fmt, n_buckets=buckets, whole_table=True)
    elif mode == "append":
        _save(df, root, mode=mode, fmt=fmt, n_buckets=layout.stored_buckets(df.sparkSession, root) or buckets)
    else:
        replace_pairs(df, root, fmt=fmt, buckets=buckets)


def write_raw_json(df: DataFrame, root: str, *, mode: str = "overwrite", buckets: int = DEFAULT_BUCKETS) -> None:
    """Raw zone: JSON lines, laid out by ``layout``.

    A run replaces the instruments it carries and no others; ``mode="append"`` adds a delivery.
    JSON lines (not one array per file) so the files stay splittable.
    """
    df = df.drop("pair")
    if mode == "append":
        _save(df, root, mode=mode, fmt="json", n_buckets=layout.stored_buckets(df.sparkSession, root) or buckets)
    else:
        replace_pairs(df, root, fmt="json", buckets=buckets)


def replace_pairs(df: DataFrame, root: str, touched: DataFrame | None = None, *, fmt: str = "parquet",
                  buckets: int = DEFAULT_BUCKETS) -> None:
    """``df`` becomes the whole content of the ``touched`` instruments (columns from_symbol,
    to_symbol; by default those it carries): one that has no rows in ``df`` loses what it had.

    Only the buckets of touched instruments are read and rewritten, as a literal list of at most
    ``buckets`` numbers; the other instruments of these buckets are laid beside the new rows.
    """
    spark = df.sparkSession
    n = layout.stored_buckets(spark, root)
    if n is None:
        _save(df, root, mode="overwrite", fmt=fmt, n_buckets=buckets)
        return
    held = df.persist() if touched is None else df  # its instruments are asked for before its rows
    try:
        given = (df if touched is None else touched).select("from_symbol", "to_symbol").distinct()
        names = layout.with_layout(with_pair(given), n).select("pair", BUCKET)
        where = [r[BUCKET] for r in names.select(BUCKET).distinct().collect()]
        old = _read(spark, root, fmt, df).where(F.col(BUCKET).isin(where))
        owned = layout.touched_partitions(old)
        others = with_pair(old).join(names.select("pair"), "pair", "left_anti").select(
            *[c for c in old.columns if c not in PARTITIONS])
        replace_partitions(held.unionByName(others, allowMissingColumns=True), root, owned, fmt=fmt, n_buckets=n)
    finally:
        if touched is None:
            held.unpersist()


def write_raw_json_arrays(df: DataFrame, root: str, *, buckets: int = DEFAULT_BUCKETS) -> None:
    """Raw zone in the provider-file layout: each file one JSON array of an instrument's records.

    An instrument is one array, however many splits its records come from, so files grow with the
    instruments alone. Only one with more records than a mean split of ``df`` is dealt over several
    arrays, by a hash of its records, so an array stays near a split however many rows an instrument
    has; there are fewer such instruments than splits. Every array goes to its own
    file (``maxRecordsPerFile=1``) in its bucket's folder, as ``multiLine`` readers expect. Such
    files cannot be split on read; prefer ``write_raw_json`` for bulk. Records in an array are
    in date order (structs compare field by field, date first).
    """
    rows = df.drop("pair").persist()  # counted before it is written
    try:
        cols = rows.columns
        if "date" in cols:
            cols = ["date"] + [c for c in cols if c != "date"]
        total, splits = rows.select(F.spark_partition_id().alias("split")).agg(
            F.count(F.lit(1)), F.count_distinct("split")).first()
        share = max(1, -(-total // max(1, splits)))
        large = (rows.groupBy(F.col("from_symbol").alias("_from"), F.col("to_symbol").alias("_to"))
                 .agg(F.ceil(F.count(F.lit(1)) / F.lit(share)).alias("_parts")).where("_parts > 1"))
        same = F.col("from_symbol").eqNullSafe(F.col("_from")) & F.col("to_symbol").eqNullSafe(F.col("_to"))
        dealt = rows.join(F.broadcast(large), same, "left")
        part = F.pmod(F.xxhash64(*cols), F.coalesce("_parts", F.lit(1))).alias("_part")
        n = layout.stored_buckets(df.sparkSession, root) or buckets
        arrays = dealt.groupBy("from_symbol", "to_symbol", part).agg(
            F.to_json(F.array_sort(F.collect_list(F.struct(*cols))),
                      {"timestampFormat": JSON_TIMESTAMP_FORMAT}).alias("value"))
        (layout.with_layout(arrays, n).select(*PARTITIONS, "value").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", 1)
         .partitionBy(*PARTITIONS).text(root))
    finally:
        rows.unpersist()
