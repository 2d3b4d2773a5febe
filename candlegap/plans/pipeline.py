"""The bronze -> silver -> gold jobs, composed from the operators.

``build_silver`` / ``build_gold`` are pure DataFrame -> DataFrame plans; the
``run_*`` jobs add the reads and writes. A job performs one write action and
counts rows at several points of its plan through ``Observation``s filled during that
write (``LayerRun``): no extra ``count()`` jobs, no re-computation for summaries. Only rows that
satisfy the layer's NOT NULL columns are written.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from candlegap.functions.columns import DEFAULT_PIP_FACTOR, PAIR_KEYS, pair_symbols, timestamp_literal
from candlegap.operators.enrich import derive_fields
from candlegap.operators.gaps import detect_gaps, gap_fill_close, gap_fill_future
from candlegap.operators.merge import upsert_bars
from candlegap.operators.quality import cast_bars, clean_bars, dedup_latest, reject_reason
from candlegap.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA, broken_not_null, conform
from candlegap.sinks import layout
from candlegap.sinks.files import (
    observed,
    replace_pairs,
    replace_partitions,
    staged,
    write_layer,
    write_raw_json,
)
from candlegap.sinks.layout import DEFAULT_BUCKETS, Pair, with_pair
from candlegap.sources.documents import (
    REJECTED,
    WARNING,
    classify_documents,
    flatten_documents,
    read_documents,
)
from candlegap.sources.files import scan_layer, scan_partitions, scan_raw_json


def stamp_ingest(raw: DataFrame, run_ts: str | None) -> DataFrame:
    """Bronze: one record per (date, pair), the one delivered last by its own stamp, with
    symbols in upper case and this run's instant as ``_ingest_timestamp``. The delivered
    stamps are compared before the run's one replaces them; afterwards all tie."""
    symbols = raw.withColumns({c: F.upper(F.col(c)) for c in PAIR_KEYS})
    return dedup_latest(symbols).withColumn("_ingest_timestamp", timestamp_literal(run_ts))


def build_silver(bronze: DataFrame) -> DataFrame:
    """cast -> clean -> dedup -> derive, in the silver column order.

    Dedup runs before the derived fields, so a duplicated day cannot take its
    own twin as the previous close. Plan: one partial/final aggregation for
    dedup (copies collapse map-side), then one shuffle by instrument and one
    sort by date for ``lag``; on input without copies this equals
    deriving first and deduplicating after.
    """
    typed = clean_bars(cast_bars(bronze))
    names = BRONZE_SCHEMA.fieldNames()
    return derive_silver(dedup_latest(typed if typed.columns == names else typed.select(*names)))


def derive_silver(unique: DataFrame) -> DataFrame:
    """The derived fields of clean bars, one row per key, in the silver column order."""
    return conform(derive_fields(unique), SILVER_SCHEMA)


def build_gold(
    silver: DataFrame,
    *,
    run_ts: str | None,
    levels: str = "ordered",
    fill: str = "close",
    pip_factor: int | Column = DEFAULT_PIP_FACTOR,
) -> DataFrame:
    """Gaps with ``is_filled`` and ``_updated_at``, in the gold column order.

    ``fill="close"``: the gap bar's own close re-enters the zone;
    ``fill="future"``: a later bar trades through the zone (ordered levels).
    """
    if fill == "close":
        gaps = gap_fill_close(detect_gaps(silver, levels=levels, pip_factor=pip_factor))
    elif fill == "future":
        if levels != "ordered":
            raise ValueError("fill='future' is defined on ordered levels")
        gaps = gap_fill_future(silver, pip_factor=pip_factor)
    else:
        raise ValueError(f"fill must be 'close' or 'future', not {fill!r}")
    return conform(gaps.withColumn("_updated_at", timestamp_literal(run_ts)), GOLD_SCHEMA)


class LayerRun(int):
    """What a job did: as a number the rows written, and by name what it counted on the way:
    ``read`` (rows of its input), ``rejected`` (broke a rule), ``unique`` (left after one row
    per key was kept), ``violating`` (NULL where the layer allows none), ``written``."""

    counts: dict[str, int]

    def __new__(cls, **counts: int) -> LayerRun:
        run = super().__new__(cls, counts["written"])
        run.counts = counts
        return run

    def __getattr__(self, name: str) -> int:
        try:
            return self.__dict__["counts"][name]
        except KeyError:
            raise AttributeError(name) from None

    def __repr__(self) -> str:
        return f"LayerRun({', '.join(f'{k}={v}' for k, v in self.counts.items())})"


class RowCounts:
    """Counts taken while one write runs: ``at`` puts a counting point into the plan."""

    def __init__(self) -> None:
        self._points: dict[str, tuple[Observation, DataFrame]] = {}

    def at(self, df: DataFrame, name: str, what: Column | None = None) -> DataFrame:
        """``df``, whose rows (or those that satisfy ``what``) are counted as ``name``."""
        seen = Observation(name)
        rows = (F.count(F.lit(1)) if what is None else F.count_if(what)).alias("rows")
        self._points[name] = seen, df.agg(rows)
        return df.observe(seen, rows)

    def taken(self) -> dict[str, int]:
        """The counts, after the write."""
        return {name: observed(seen, rows)["rows"] for name, (seen, rows) in self._points.items()}


def checked(df: DataFrame, layer: str, counts: RowCounts) -> DataFrame:
    """Rows fit for ``layer``: those with a NULL in one of its NOT NULL columns are counted as
    ``violating`` and go, the others are counted as ``written``."""
    broken = broken_not_null(layer)
    return counts.at(counts.at(df, "violating", broken.isNotNull()).where(broken.isNull()), "written")


def layer_row_counts(bronze: DataFrame) -> DataFrame:
    """(layer, n_rows) of bronze and what is built from it: one pass over ``bronze`` through silver
    to its gaps, counted at three points of that plan."""
    counts = RowCounts()
    silver = counts.at(build_silver(counts.at(bronze, "bronze")), "silver")
    counts.at(detect_gaps(silver), "gold").write.format("noop").mode("overwrite").save()
    return bronze.sparkSession.createDataFrame(list(counts.taken().items()), "layer string, n_rows long")


def run_documents(spark: SparkSession, docs_path: str, raw_root: str, *, ingest_ts: str,
                  source: str, multi_line: bool = False, buckets: int = DEFAULT_BUCKETS) -> dict[str, int]:
    """Landed provider documents -> raw zone (JSON lines).

    Rejected documents (error message, no series) are skipped and counted,
    documents with a note are kept and counted as warnings.
    """
    docs = classify_documents(read_documents(spark, docs_path, multi_line=multi_line))
    counts = RowCounts()
    docs = counts.at(docs, "documents")
    docs = counts.at(docs, "rejected", F.col("status") == REJECTED)
    docs = counts.at(docs, "warnings", F.col("status") == WARNING)
    rows = counts.at(flatten_documents(docs, ingest_ts=ingest_ts, source=source), "rows")
    write_raw_json(rows, raw_root, buckets=buckets)
    return counts.taken()


def _incoming(incoming: DataFrame, n_buckets: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """A batch with its partition columns, and which partitions it touches."""
    laid = layout.with_layout(with_pair(incoming.drop("pair")), n_buckets)
    return laid, layout.touched_partitions(laid)


def _merged(spark: SparkSession, incoming: DataFrame, bronze_root: str, n_buckets: int,
            parts: list[tuple[int, int]]) -> DataFrame:
    """``incoming`` upserted into the stored rows of the partitions ``parts``."""
    stored = scan_partitions(spark, bronze_root, merge_schema=True)  # with the columns of earlier batches
    history = layout.without_layout(layout.in_partitions(stored, parts))
    return upsert_bars(history.drop("pair"), layout.without_layout(incoming).drop("pair"))


def merge_into_bronze(spark: SparkSession, incoming: DataFrame, bronze_root: str) -> DataFrame:
    """``incoming`` bronze rows upserted into the stored rows of the (bucket, month) partitions
    they touch; returns all rows of those partitions.

    The touched partitions reach the driver (at most buckets x months of them) and become literal
    filters of the scan of history, so a batch of one bar lists and reads one partition. Upsert is
    by (date, pair), incoming rows win: the same batch twice gives the same table.
    """
    n = layout.stored_buckets(spark, bronze_root)
    if n is None:
        return incoming.drop("pair")
    laid, parts = _incoming(incoming, n)
    return _merged(spark, laid, bronze_root, n, parts)


def write_merged(spark: SparkSession, incoming: DataFrame, bronze_root: str, counts: RowCounts | None = None,
                 buckets: int = DEFAULT_BUCKETS) -> None:
    """``merge_into_bronze`` and its write: the touched partitions are replaced, no other one is
    read or rewritten, and nothing is staged beside the table (Spark moves the new partitions
    into place once all are complete)."""
    counts = counts or RowCounts()
    n = layout.stored_buckets(spark, bronze_root)
    if n is None:
        write_layer(checked(incoming, "bronze", counts), bronze_root, buckets=buckets)
        return
    laid, parts = _incoming(incoming, n)
    merged = _merged(spark, laid, bronze_root, n, parts)
    replace_partitions(with_pair(checked(merged, "bronze", counts)), bronze_root, parts, n_buckets=n)


def run_bronze(spark: SparkSession, raw_root: str, bronze_root: str, *, run_ts: str,
               pairs: Iterable[Pair] | None = None, multi_line: bool = False,
               merge: bool = False, buckets: int = DEFAULT_BUCKETS) -> LayerRun:
    """Raw JSON -> bronze table. Skips the write when there is no input
    (``isEmpty`` is a one-row job, not a count). Returns rows written, and read.

    Default: the instruments in this run replace what bronze has of them (a
    delivery is an instrument's whole history). ``merge=True`` keeps history
    instead (``merge_into_bronze``): a short delivery after a long one only
    updates and adds days, and ``written`` counts the rows of the rewritten partitions.
    """
    raw = scan_raw_json(spark, raw_root, pairs=pairs, multi_line=multi_line)
    if raw.isEmpty():
        return LayerRun(read=0, violating=0, written=0)
    counts = RowCounts()
    bronze = stamp_ingest(counts.at(raw.drop("pair"), "read"), run_ts)
    if merge:
        with staged(bronze, "incoming") as held:  # asked for its partitions, then merged
            write_merged(spark, held, bronze_root, counts, buckets)
            return LayerRun(**counts.taken())  # may ask the staged rows
    write_layer(checked(bronze, "bronze", counts), bronze_root, buckets=buckets)
    return LayerRun(**counts.taken())


def _replace(df: DataFrame, root: str, pairs: list[Pair] | None, buckets: int) -> None:
    """The job's result as the whole table, or as the whole content of the named instruments.
    Nothing that is stored goes before the new rows are complete."""
    if pairs is None:
        write_layer(df, root, whole_table=True, buckets=buckets)
    else:
        symbols = [pair_symbols(p) for p in pairs]
        touched = df.sparkSession.createDataFrame(symbols, "from_symbol string, to_symbol string")
        replace_pairs(with_pair(df), root, touched, buckets=buckets)


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, *,
               pairs: Iterable[Pair] | None = None, rejects_root: str | None = None,
               buckets: int = DEFAULT_BUCKETS) -> LayerRun:
    """Bronze -> silver, of all instruments or of ``pairs``. Those whose bars are all rejected
    end up without rows. Returns rows written; by name also the bars read, rejected by a rule,
    unique, and violating a NOT NULL column. With ``rejects_root`` the bars that were not
    written for such a reason are kept there with it (``reject_reason``): one more pass over
    bronze, made only if there were any.
    """
    pairs = None if pairs is None else list(pairs)
    bronze = scan_layer(spark, bronze_root, pairs=pairs, schema=BRONZE_SCHEMA).drop("pair")
    counts = RowCounts()
    typed = counts.at(counts.at(cast_bars(bronze), "read"), "rejected", reject_reason().isNotNull())
    silver = derive_silver(counts.at(dedup_latest(clean_bars(typed)), "unique"))
    _replace(checked(silver, "silver", counts), silver_root, pairs, buckets)
    run = LayerRun(**counts.taken())
    if rejects_root is not None:
        rejects = silver_rejects(bronze) if run.rejected or run.violating else silver_rejects(bronze).limit(0)
        _replace(rejects, rejects_root, pairs, buckets)
    return run


def silver_rejects(bronze: DataFrame) -> DataFrame:
    """Bronze rows that no silver table holds, as they came, with ``reject_reason``: the first
    rule that their typed form breaks, or the NOT NULL column that is NULL in it."""
    typed = cast_bars(bronze.withColumn("_came", F.struct(*bronze.columns)))
    reason = F.coalesce(reject_reason(), broken_not_null("silver", typed.columns))
    return typed.withColumn("reject_reason", reason).where("reject_reason IS NOT NULL").select("_came.*", "reject_reason")


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, *, run_ts: str,
             pairs: Iterable[Pair] | None = None, levels: str = "ordered",
             fill: str = "close", buckets: int = DEFAULT_BUCKETS) -> LayerRun:
    """Silver -> gold, of all instruments or of ``pairs``. Those that lost their gaps end up
    without rows. Returns rows written; by name also the bars read and the gaps violating a NOT NULL
    column."""
    pairs = None if pairs is None else list(pairs)
    silver = scan_layer(spark, silver_root, pairs=pairs, schema=SILVER_SCHEMA).drop("pair")
    counts = RowCounts()
    gold = build_gold(counts.at(silver, "read"), run_ts=run_ts, levels=levels, fill=fill)
    _replace(checked(gold, "gold", counts), gold_root, pairs, buckets)
    return LayerRun(**counts.taken())
