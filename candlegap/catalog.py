"""Registered queries: one per operator of the blueprint, over the given tables.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame. All of
them start from the whole ``events`` table (see ``sources.events``), so the
work grows with the data; round-trip queries write to fresh folders under the
session's shared checkpoint folder and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlegap import operators as op
from candlegap.functions.columns import quote_pip_factor
from candlegap.plans import incremental, pipeline, reports
from candlegap.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA, conform, null_violations
from candlegap.sinks.files import write_layer, write_raw_json, write_raw_json_arrays
from candlegap.sinks.paths import scratch_path
from candlegap.sources.documents import (
    ERROR_KEY,
    FROM_KEY,
    META_KEY,
    NOTE_KEY,
    SERIES_KEY,
    bronze_to_documents,
    classify_documents,
    flatten_documents,
    read_documents,
)
from candlegap.sources.events import (
    bars_to_bronze,
    event_bars,
    events_as_bronze_copies,
    load_events,
)
from candlegap.sources.files import scan_layer, scan_raw_json

# Fixed test parameters shared with the SQL oracle.
RUN_TS = "2024-02-01 00:00:00"
RUN_TS_2 = "2024-02-02 00:00:00"
UPSERT_EXISTING_UNTIL = "2024-01-20"
UPSERT_INCOMING_FROM = "2024-01-15"
WHITELIST = ("U1", "U2", "U3", "U4", "U5", "USD")
NOTE_TEXT = "call frequency limit reached"
TOP = 10
ONE_PAIR = ("U1", "USD")
#: Layout of the tables that the queries write, which are small beside the library's default.
BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]


def _utc(spark: SparkSession) -> None:
    # bar dates and stamps are defined in UTC
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "Z"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _bars(spark: SparkSession, sf: str) -> DataFrame:
    _utc(spark)
    return event_bars(load_events(spark, sf))


def bronze(spark, sf, **variant) -> DataFrame:
    return bars_to_bronze(_bars(spark, sf), **variant)


def replay_batch(spark, sf) -> DataFrame:
    """Later re-delivery: prices x2, stamped a day later, from mid-month."""
    b = bronze(spark, sf, price_factor=2.0, stamp_shift_days=1)
    return b.filter(F.col("date") >= UPSERT_INCOMING_FROM)


def typed(spark, sf) -> DataFrame:
    return op.clean_bars(op.cast_bars(bronze(spark, sf)))


def silver(spark, sf, **variant) -> DataFrame:
    return pipeline.build_silver(bronze(spark, sf, **variant))


def gaps_ordered(spark, sf, **variant) -> DataFrame:
    return op.gap_fill_close(op.detect_gaps(silver(spark, sf, **variant)))


def documents(spark, sf) -> DataFrame:
    """One document per instrument; by user_id % 10: 0 an error document (no
    metadata, no series), 1 a rate-limit note beside the series, 2 no series."""
    docs = bronze_to_documents(bronze(spark, sf)).withColumn(
        "_k", F.col(f"`{META_KEY}`")[FROM_KEY])
    k = F.substring("_k", 2, 20).cast("long") % 10
    meta, series = F.col(f"`{META_KEY}`"), F.col(f"`{SERIES_KEY}`")
    return docs.select(
        F.when(k == 0, F.lit(None)).otherwise(meta).alias(META_KEY),
        F.when(k.isin(0, 2), F.lit(None)).otherwise(series).alias(SERIES_KEY),
        F.when(k == 0, F.concat(F.lit("Invalid API call for "), F.col("_k"))).alias(ERROR_KEY),
        F.when(k == 1, F.lit(NOTE_TEXT)).alias(NOTE_KEY),
    )


def _documents_round_trip(spark, sf) -> DataFrame:
    path = scratch_path(spark, "documents")
    documents(spark, sf).write.mode("overwrite").json(path)
    return read_documents(spark, path)


# -- gap detection -----------------------------------------------------------

def q_neighbour_bars(spark, sf):
    return op.neighbour_bars(silver(spark, sf))


def q_detect_bullish(spark, sf):
    return op.detect_bullish(silver(spark, sf))


def q_detect_bearish(spark, sf):
    return op.detect_bearish(silver(spark, sf))


def q_detect_gaps(spark, sf):
    return op.detect_gaps(silver(spark, sf))


def q_detect_gaps_positional(spark, sf):
    return op.detect_gaps(silver(spark, sf), levels="positional")


def q_detect_gaps_union(spark, sf):
    return op.detect_gaps_union(silver(spark, sf))


def q_gap_size_pips(spark, sf):
    # per-quote pip size (0.01 for JPY quotes, else 0.0001)
    g = op.detect_gaps(silver(spark, sf), pip_factor=quote_pip_factor())
    return g.select("date", "from_symbol", "to_symbol", "fvg_type", "fvg_high", "fvg_low",
                    "fvg_size_pips")


def q_gap_fill_close(spark, sf):
    return gaps_ordered(spark, sf)


def q_gap_fill_close_positional(spark, sf):
    return _positional_gold(spark, sf)


def q_gap_fill_future(spark, sf):
    return op.gap_fill_future(silver(spark, sf))


def q_gap_first_fill(spark, sf):
    return op.gap_first_fill(silver(spark, sf))


# the same operators with an instrument in many tasks: blocks of a few bars, as the given
# tables hold short histories only
BLOCK = 8


def q_neighbour_bars_blocks(spark, sf):
    return op.neighbour_bars_in_blocks(silver(spark, sf), BLOCK)


def q_detect_gaps_blocks(spark, sf):
    return op.detect_gaps_in_blocks(silver(spark, sf), block_bars=BLOCK)


def q_gap_fill_future_blocks(spark, sf):
    return op.gap_fill_future_in_blocks(silver(spark, sf), block_bars=BLOCK)


def q_daily_return_blocks(spark, sf):
    return op.derive_fields_in_blocks(typed(spark, sf), BLOCK)


def q_rolling_volatility_blocks(spark, sf):
    return op.rolling_volatility_in_blocks(silver(spark, sf), block_bars=BLOCK)


def q_gap_first_fill_blocks(spark, sf):
    """First fills by a tree of block extremes, without a Python worker."""
    return op.gap_first_fill_in_blocks(silver(spark, sf), fanout=4, block_bars=BLOCK)


# -- silver ------------------------------------------------------------------

def q_cast_bars(spark, sf):
    return op.cast_bars(bronze(spark, sf, malformed=True))


def q_clean_bars(spark, sf):
    return op.clean_bars(op.cast_bars(bronze(spark, sf, malformed=True)))


def q_rejected_bars(spark, sf):
    return op.rejected_bars(op.cast_bars(bronze(spark, sf, malformed=True)))


def q_valid_symbols(spark, sf):
    return op.valid_symbols(silver(spark, sf), WHITELIST)


def q_dedup_latest(spark, sf):
    _utc(spark)
    return op.dedup_latest(events_as_bronze_copies(load_events(spark, sf)))


def q_daily_range(spark, sf):
    return op.daily_range(typed(spark, sf))


def q_daily_return(spark, sf):
    return op.daily_return(op.daily_range(typed(spark, sf)))


def q_build_silver(spark, sf):
    return pipeline.build_silver(
        bronze(spark, sf, malformed=True).unionByName(replay_batch(spark, sf)))


# -- reports -----------------------------------------------------------------

def q_report_gaps_by_size(spark, sf):
    return reports.report_gaps_by_size(gaps_ordered(spark, sf))


def q_report_active_gaps(spark, sf):
    return reports.report_active_gaps(gaps_ordered(spark, sf))


def q_report_fill_rate(spark, sf):
    return reports.report_fill_rate(gaps_ordered(spark, sf))


def q_report_fill_rate_positional(spark, sf):
    """Fill rate over gold built the reference's way (positional levels)."""
    return reports.report_fill_rate(_positional_gold(spark, sf))


def q_report_monthly_activity(spark, sf):
    return reports.report_monthly_activity(gaps_ordered(spark, sf, spread_months=True))


def q_report_monthly_activity_all(spark, sf):
    """Monthly activity over all instruments together (one row per month)."""
    g = gaps_ordered(spark, sf, spread_months=True)
    return reports.report_monthly_activity(g, by_pair=False)


def q_rolling_volatility(spark, sf):
    return op.rolling_volatility(silver(spark, sf))


def q_report_volatility(spark, sf):
    return reports.report_volatility(silver(spark, sf))


def q_report_largest_moves(spark, sf):
    return reports.report_largest_moves(silver(spark, sf), TOP)


def q_largest_moves_per_pair(spark, sf):
    return reports.largest_moves_per_pair(silver(spark, sf), TOP)


def q_gap_summary(spark, sf):
    return reports.gap_summary(gaps_ordered(spark, sf))


def q_largest_gaps(spark, sf):
    return reports.largest_gaps(gaps_ordered(spark, sf), TOP)


def _positional_gold(spark, sf) -> DataFrame:
    return op.gap_fill_close(op.detect_gaps(silver(spark, sf), levels="positional"))


def q_report_gaps_by_size_positional(spark, sf):
    return reports.report_gaps_by_size(_positional_gold(spark, sf))


def q_report_active_gaps_positional(spark, sf):
    return reports.report_active_gaps(_positional_gold(spark, sf))


def q_gap_summary_positional(spark, sf):
    """The five summary counts over gold built the reference's way."""
    return reports.gap_summary(_positional_gold(spark, sf))


def q_largest_gaps_positional(spark, sf):
    """The largest-gaps listing over gold built the reference's way."""
    return reports.largest_gaps(_positional_gold(spark, sf), TOP, order="signed")


def q_latest_active_gaps(spark, sf):
    return reports.latest_active_gaps(gaps_ordered(spark, sf), TOP)


def q_latest_bars(spark, sf):
    return reports.latest_bars(silver(spark, sf), TOP)


def q_latest_bronze_bars(spark, sf):
    """The 5 newest bronze rows (text prices), the bronze job's preview."""
    return reports.latest_bars(bronze(spark, sf), 5)


def q_last_date(spark, sf):
    """The newest date of the whole table."""
    return silver(spark, sf).agg(F.max("date").alias("last_date"))


def q_report_volatility_join(spark, sf):
    """The volatility report with a stored gold table: the join form."""
    s = silver(spark, sf)
    return reports.report_volatility(s, op.gap_fill_close(op.detect_gaps(s)))


def q_rebuild_after_correction(spark, sf):
    """Silver and gold rebuilt by the jobs after a delivery in which no bar of some pairs is
    valid any more: what those pairs had before must be gone. The bars of even users are
    delivered anew with a price of zero; both gold states are compared by pair."""
    raw1, raw2 = scratch_path(spark, "raw-first"), scratch_path(spark, "raw-second")
    b, s, g = (scratch_path(spark, f"rebuilt-{layer}") for layer in ("bronze", "silver", "gold"))
    first = bronze(spark, sf)
    even = F.substring("from_symbol", 2, 20).cast("long") % 2 == 0
    write_raw_json(first, raw1, buckets=BUCKETS)
    write_raw_json(first.where(even).withColumns({c: F.lit("0") for c in ("open", "high", "low", "close")})
                   .withColumn("_ingest_timestamp", F.col("_ingest_timestamp") + F.make_dt_interval(F.lit(1))), raw2, buckets=BUCKETS)
    for raw in (raw1, raw2):
        pipeline.run_bronze(spark, raw, b, run_ts=RUN_TS, merge=True, buckets=BUCKETS)
        pipeline.run_silver(spark, b, s, buckets=BUCKETS)
        pipeline.run_gold(spark, s, g, run_ts=RUN_TS, buckets=BUCKETS)
    return scan_layer(spark, g, schema=GOLD_SCHEMA).select(
        "date", "from_symbol", "to_symbol", "fvg_type", "fvg_high", "fvg_low", "fvg_size_pips", "is_filled")


def q_last_bar_date(spark, sf):
    return reports.last_bar_date(silver(spark, sf))


def q_report_largest_moves_in_parallel(spark, sf):
    return reports.report_largest_moves_in_parallel(silver(spark, sf), TOP)


def _positioned(name: str, build: Callable[[DataFrame], DataFrame], layer: Query) -> Query:
    def run(spark, sf):
        return reports.positioned(build(layer(spark, sf)), name)

    run.__doc__ = f"The rows of {name} with their place in its order."
    return run


for _name in reports.ORDERS:
    globals()[f"q_position_{_name}"] = _positioned(
        _name, getattr(reports, _name),
        silver if _name in ("report_volatility", "report_largest_moves") else gaps_ordered)


def q_raw_file_order(spark, sf):
    """Two documents an instrument, the later days delivered first, through the ingest job: each
    record with its place among its instrument's records as the files hold them."""
    docs, raw = scratch_path(spark, "docs-order"), scratch_path(spark, "raw-order")
    b = bronze(spark, sf)
    for late in (True, False):
        part = b.where((F.col("date") >= UPSERT_INCOMING_FROM) == late)
        bronze_to_documents(part).write.mode("append").json(docs)
    pipeline.run_documents(spark, docs, raw, ingest_ts=RUN_TS, source="events", buckets=BUCKETS)
    rows = spark.read.schema(BRONZE_SCHEMA).json(raw).select(
        "date", "from_symbol", "to_symbol", "month", F.input_file_name().alias("file"),
        F.monotonically_increasing_id().alias("line"))
    held = Window.partitionBy("from_symbol", "to_symbol").orderBy("month", "file", "line")
    return rows.select("date", "from_symbol", "to_symbol", F.row_number().over(held).cast("long").alias("position"))


# -- sources and sinks ---------------------------------------------------------

def q_classify_documents(spark, sf):
    return classify_documents(_documents_round_trip(spark, sf)).select(
        "from_symbol", "to_symbol", "status", "reason", "n_days")


def q_flatten_documents(spark, sf):
    return flatten_documents(_documents_round_trip(spark, sf), ingest_ts=RUN_TS,
                             source="events")


def q_ingest_documents(spark, sf):
    """Landed documents -> raw zone through the ingest job, read back."""
    docs, raw = scratch_path(spark, "docs"), scratch_path(spark, "raw-docs")
    documents(spark, sf).write.mode("overwrite").json(docs)
    pipeline.run_documents(spark, docs, raw, ingest_ts=RUN_TS, source="events", buckets=BUCKETS)
    return scan_raw_json(spark, raw)


def q_write_raw_json(spark, sf):
    root = scratch_path(spark, "raw-lines")
    write_raw_json(bronze(spark, sf), root, buckets=BUCKETS)
    return scan_raw_json(spark, root)


def q_scan_raw_json(spark, sf):
    root = scratch_path(spark, "raw-arrays")
    write_raw_json_arrays(bronze(spark, sf), root, buckets=BUCKETS)
    return scan_raw_json(spark, root, multi_line=True)


def q_scan_bars(spark, sf):
    root = scratch_path(spark, "silver")
    write_layer(silver(spark, sf), root, buckets=BUCKETS)
    return scan_layer(spark, root)


def q_scan_one_pair(spark, sf):
    """One instrument of the stored table, by its symbols: one bucket is read."""
    root = scratch_path(spark, "silver-one")
    write_layer(silver(spark, sf), root, buckets=BUCKETS)
    return scan_layer(spark, root, pairs=[ONE_PAIR])


def q_run_one_pair(spark, sf):
    """The reference's own interface: bronze to gold for one instrument, beside whose layers
    those of all others stay."""
    b, s, g = (scratch_path(spark, f"one-{layer}") for layer in ("bronze", "silver", "gold"))
    write_layer(bronze(spark, sf), b, buckets=BUCKETS)
    pipeline.run_silver(spark, b, s, buckets=BUCKETS)
    pipeline.run_silver(spark, b, s, pairs=[ONE_PAIR], buckets=BUCKETS)
    pipeline.run_gold(spark, s, g, run_ts=RUN_TS, pairs=[ONE_PAIR], buckets=BUCKETS)
    return scan_layer(spark, g)


def _malformed_run(spark, sf):
    b, s, r = (scratch_path(spark, f"checked-{layer}") for layer in ("bronze", "silver", "rejects"))
    write_layer(bronze(spark, sf, malformed=True).unionByName(replay_batch(spark, sf)), b, buckets=BUCKETS)
    return pipeline.run_silver(spark, b, s, rejects_root=r, buckets=BUCKETS), r


def q_silver_run_counts(spark, sf):
    """What the silver job counts at four points of its one write."""
    run, _ = _malformed_run(spark, sf)
    return spark.createDataFrame(list(run.counts.items()), "point string, n_rows long")


def q_silver_rejects(spark, sf):
    """The bronze rows that the checked silver sink refused, as they came, with the reason."""
    return scan_layer(spark, _malformed_run(spark, sf)[1])


def q_load_bronze(spark, sf):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "bronze")
    write_raw_json(bronze(spark, sf), raw, buckets=BUCKETS)
    pipeline.run_bronze(spark, raw, out, run_ts=RUN_TS, buckets=BUCKETS)
    return scan_layer(spark, out)


def q_load_bronze_merge(spark, sf):
    """Full delivery, then a re-delivery from mid-month merged into history."""
    raw1, raw2 = scratch_path(spark, "raw-full"), scratch_path(spark, "raw-replay")
    out = scratch_path(spark, "bronze-merged")
    write_raw_json(bronze(spark, sf), raw1, buckets=BUCKETS)
    pipeline.run_bronze(spark, raw1, out, run_ts=RUN_TS, buckets=BUCKETS)
    write_raw_json(replay_batch(spark, sf), raw2, buckets=BUCKETS)
    pipeline.run_bronze(spark, raw2, out, run_ts=RUN_TS_2, merge=True, buckets=BUCKETS)
    return scan_layer(spark, out)


def q_write_layer(spark, sf):
    root = scratch_path(spark, "gold")
    write_layer(pipeline.build_gold(silver(spark, sf), run_ts=RUN_TS), root, buckets=BUCKETS)
    return scan_layer(spark, root)


def q_upsert_bars(spark, sf):
    existing = bronze(spark, sf).filter(F.col("date") <= UPSERT_EXISTING_UNTIL)
    return op.upsert_bars(existing, replay_batch(spark, sf))


def q_evolve_schema(spark, sf):
    root = scratch_path(spark, "evolve")
    write_layer(bronze(spark, sf), root, buckets=BUCKETS)
    second = replay_batch(spark, sf).withColumn("_batch_note", F.lit("replay"))
    write_layer(second, root, mode="append", buckets=BUCKETS)
    return scan_layer(spark, root, merge_schema=True).select(
        *BRONZE_SCHEMA.fieldNames(), "_batch_note", "pair")


def q_conform_layer(spark, sf):
    s = silver(spark, sf)
    messy = s.select(*reversed(s.columns)).withColumns(
        {c: F.col(c).cast("string") for c in ("open", "high", "low", "close")}
    ).withColumn("_extra", F.lit(1))
    return conform(messy, "silver")


def q_null_violations(spark, sf):
    """NULLs in the silver schema's NOT NULL columns of the malformed typed bars."""
    return null_violations(op.cast_bars(bronze(spark, sf, malformed=True)), "silver")


def q_layer_row_counts(spark, sf):
    b = bronze(spark, sf, malformed=True).unionByName(replay_batch(spark, sf))
    return pipeline.layer_row_counts(b)


def q_stream_refresh(spark, sf):
    """Two deliveries into the raw zone, each picked up by an incremental
    (available-now) run of the refresh stream on one checkpoint; the second
    re-delivers days from mid-month, which must win."""
    from candlegap.streaming import start_refresh

    raw, ck = scratch_path(spark, "stream-raw"), scratch_path(spark, "stream-ckpt")
    roots = [scratch_path(spark, f"stream-{layer}") for layer in ("bronze", "silver", "gold")]
    write_raw_json(bronze(spark, sf), raw, buckets=BUCKETS)
    start_refresh(spark, raw, *roots, checkpoint=ck, buckets=BUCKETS).awaitTermination()
    write_raw_json(replay_batch(spark, sf), raw, mode="append", buckets=BUCKETS)
    start_refresh(spark, raw, *roots, checkpoint=ck, buckets=BUCKETS).awaitTermination()
    return scan_layer(spark, roots[2]).drop("_updated_at")


def _refreshed(spark, sf) -> incremental.Roots:
    """A full delivery, then a later one from mid-month on, through the batch refresh."""
    roots = incremental.Roots(*(scratch_path(spark, f"refresh-{x}") for x in ("bronze", "silver", "gold", "state")), buckets=BUCKETS)
    for batch in (bronze(spark, sf), replay_batch(spark, sf)):
        raw = scratch_path(spark, "refresh-raw")
        write_raw_json(batch, raw, buckets=BUCKETS)
        incremental.run_refresh(spark, raw, roots, run_ts=RUN_TS)
    return roots


def q_refresh_silver(spark, sf):
    """Silver after a correction, recomputed from the first changed day with a halo bar."""
    return scan_layer(spark, _refreshed(spark, sf).silver, schema=SILVER_SCHEMA).drop("_ingest_timestamp")


def q_refresh_gold(spark, sf):
    """Gold after a correction, recomputed from the bar before the first changed day."""
    return scan_layer(spark, _refreshed(spark, sf).gold, schema=GOLD_SCHEMA).drop("_updated_at")


def q_state_fill_rate(spark, sf):
    return incremental.state_fill_rate(scan_layer(spark, _refreshed(spark, sf).state))


def q_state_monthly_activity(spark, sf):
    return incremental.state_monthly_activity(scan_layer(spark, _refreshed(spark, sf).state))


def q_state_summary(spark, sf):
    return incremental.state_summary(scan_layer(spark, _refreshed(spark, sf).state))


def q_volatility_since(spark, sf):
    """Rolling means from a changed day on, with 19 halo bars before it."""
    s = silver(spark, sf)
    starts = incremental.first_changes(bronze(spark, sf).filter(F.col("date") >= UPSERT_INCOMING_FROM))
    return incremental.volatility_since(s, starts)


def q_build_gold(spark, sf):
    return pipeline.build_gold(silver(spark, sf), run_ts=RUN_TS)


def _sql_report(name: str) -> Query:
    def run(spark, sf):
        from candlegap.plans.named_reports import register_views, run_named_report

        s = silver(spark, sf)
        views = register_views(s, op.gap_fill_close(op.detect_gaps(s)), prefix="catalog")
        return run_named_report(spark, name, *views)

    run.__doc__ = f"The {name} report over tables that are found by name."
    return run


for _name in ("report_gaps_by_size", "report_active_gaps", "report_fill_rate",
              "report_monthly_activity", "report_volatility", "report_largest_moves"):
    globals()[f"q_sql_{_name}"] = _sql_report(_name)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> bars -> silver -> gaps -> close fill -> fill rate by type."""
    return q_report_fill_rate(spark, sf_dir)
