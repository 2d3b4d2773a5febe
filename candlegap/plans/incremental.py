"""Refresh of the layers after a delivery: only what the changed days can alter is read and
recomputed.

A delivery is merged into the (bucket, month) partitions of bronze that it touches. Each touched
instrument has a first changed day. From that day on silver is recomputed from bronze; the bar
before it is taken from stored silver as a halo row, because the day's return looks back one bar.
A gap looks one bar back and one ahead, so gold is recomputed from the bar before the first changed
day, with one more bar as halo. A rolling mean over k bars needs k - 1 halo rows. Rows of other
instruments and of earlier days in the rewritten partitions are copied as they are.

What reaches the driver is bounded by the layout: for each touched bucket its first month, and
the partitions to rewrite. All of it becomes literal partition filters.

The report state holds counts, sums and maxima of the gaps of each instrument, month and type, in
the layout of gold. States of different partitions add up, so a refresh replaces the state of the
gold partitions it rewrote and of no others, also when a correction removes gaps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlegap.functions.columns import PAIR_KEYS
from candlegap.operators.enrich import rolling_volatility
from candlegap.operators.quality import cast_bars, clean_bars, dedup_latest
from candlegap.plans.pipeline import build_gold, derive_silver, stamp_ingest, write_merged
from candlegap.schemas import BRONZE_SCHEMA, GOLD_SCHEMA, SILVER_SCHEMA, broken_not_null
from candlegap.sinks import layout
from candlegap.sinks.files import replace_pairs, replace_partitions, staged, write_layer
from candlegap.sinks.layout import BUCKET, MONTH, with_layout, with_pair, without_layout
from candlegap.sources.files import scan_partitions, scan_raw_json

PAIR = list(PAIR_KEYS)


@dataclass(frozen=True)
class Roots:
    """Where the layers lie, and the buckets of those that are not there yet; without ``state``
    no report state is kept."""

    bronze: str
    silver: str
    gold: str
    state: str | None = None
    buckets: int = layout.DEFAULT_BUCKETS


# -- what a delivery changes ---------------------------------------------------

def first_changes(incoming: DataFrame) -> DataFrame:
    """``pair, from_symbol, to_symbol, start``: each touched instrument's first changed day.
    Records without a valid date change nothing that silver holds."""
    day = F.col("date").try_cast("date")
    return (with_pair(incoming.drop("pair")).groupBy("pair", *PAIR).agg(F.min(day).alias("start"))
            .where("start IS NOT NULL"))


def _first_months(starts: DataFrame, n_buckets: int) -> dict[int, int]:
    """For each touched bucket the first month to rewrite; at most ``n_buckets`` rows."""
    laid = with_layout(starts.withColumnRenamed("start", "date"), n_buckets)
    return {r[BUCKET]: r["first"] for r in laid.groupBy(BUCKET).agg(F.min(MONTH).alias("first")).collect()}


def _months(table: DataFrame, first: dict[int, int], *, later: bool) -> DataFrame:
    """Partitions of the touched buckets from their first month on, or up to and with it."""
    alike: dict[int, list[int]] = {}
    for bucket, month in sorted(first.items()):
        alike.setdefault(month, []).append(bucket)
    keep = F.lit(False)
    for month, buckets in alike.items():
        side = F.col(MONTH) >= month if later else F.col(MONTH) <= month
        keep = keep | (F.col(BUCKET).isin(buckets) & side)
    return table.where(keep)


def bars_before(silver: DataFrame, starts: DataFrame, rows: int) -> DataFrame:
    """The last ``rows`` bars of each instrument before its ``start`` (a group limit per instrument
    runs before the exchange)."""
    last = Window.partitionBy("pair").orderBy(F.col("date").desc())
    earlier = silver.join(starts.select("pair", "start"), "pair").where("date < start").drop("start")
    return earlier.withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= rows).drop("_n")


def _silver_table(spark: SparkSession, root: str) -> DataFrame:
    return scan_partitions(spark, root, schema=SILVER_SCHEMA)


def _untouched(table: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows of other instruments, and those before an instrument's start."""
    joined = table.join(starts.select("pair", F.col("start").alias("_start")), "pair", "left")
    return joined.where("_start IS NULL OR date < _start").drop("_start")


def _valid(df: DataFrame, layer: str) -> DataFrame:
    return df.where(broken_not_null(layer).isNull())


# -- silver, gold, state -------------------------------------------------------

def refresh_silver(spark: SparkSession, starts: DataFrame, roots: Roots) -> None:
    """Silver of the touched instruments from their first changed day on."""
    bronze = scan_partitions(spark, roots.bronze, schema=BRONZE_SCHEMA)
    first = _first_months(starts, layout.stored_buckets(spark, roots.bronze))
    came = _months(bronze, first, later=True).join(starts.select("pair", "start"), "pair")
    came = without_layout(came.where(F.col("date").try_cast("date") >= F.col("start"))).drop("start", "pair")
    fresh = dedup_latest(clean_bars(cast_bars(came)))
    n = layout.stored_buckets(spark, roots.silver)
    if n is None:
        write_layer(_valid(derive_silver(fresh), "silver"), roots.silver, buckets=roots.buckets)
        return
    stored = _silver_table(spark, roots.silver)
    first = _first_months(starts, n)
    halo = bars_before(without_layout(_months(stored, first, later=False)), starts, 1)
    both = fresh.unionByName(halo.select(*fresh.columns))
    new = with_pair(_valid(derive_silver(both), "silver")).join(starts.select("pair", "start"), "pair")
    new = new.where("date >= start").drop("start")
    rewritten = _months(stored, first, later=True)
    owned = layout.touched_partitions(rewritten)
    kept = _untouched(without_layout(rewritten), starts)
    replace_partitions(new.unionByName(kept), roots.silver, owned, n_buckets=n)


def gap_starts(silver: DataFrame, starts: DataFrame) -> DataFrame:
    """The day from which an instrument's gaps may differ: its last bar before the first
    changed day, as that bar's next one changed."""
    last = bars_before(silver.select("pair", "date"), starts, 1).select("pair", F.col("date").alias("last"))
    return (starts.join(last, "pair", "left")
            .select("pair", *PAIR, F.coalesce("last", "start").alias("start")))


def refresh_gold(spark: SparkSession, starts: DataFrame, roots: Roots, *, run_ts: str,
                 levels: str = "ordered") -> list[tuple[int, int]]:
    """Gold (fill by the gap bar's own close) of the touched instruments from the bar before their
    first changed day on. Returns the partitions rewritten."""
    stored = _silver_table(spark, roots.silver)
    first = _first_months(starts, layout.stored_buckets(spark, roots.silver))
    earlier = without_layout(_months(stored, first, later=False))
    with staged(gap_starts(earlier, starts), "since") as since:  # one row an instrument, asked for three times
        held = _first_months(starts, layout.stored_buckets(spark, roots.silver))
        bars = without_layout(_months(stored, held, later=True)).join(starts.select("pair", "start"), "pair")
        bars = bars.where("date >= start").drop("start").unionByName(bars_before(earlier, starts, 2))
        gaps = build_gold(bars.drop("pair"), run_ts=run_ts, levels=levels)
        new = with_pair(_valid(gaps, "gold")).join(since.select("pair", "start"), "pair")
        new = new.where("date >= start").drop("start")
        n = layout.stored_buckets(spark, roots.gold)
        if n is None:
            return sorted(replace_partitions(new, roots.gold, [], n_buckets=roots.buckets))
        table = scan_partitions(spark, roots.gold, schema=GOLD_SCHEMA)
        rewritten = _months(table, _first_months(since, n), later=True)
        owned = layout.touched_partitions(rewritten)
        kept = _untouched(without_layout(rewritten), since)
        written = replace_partitions(new.unionByName(kept), roots.gold, owned, n_buckets=n)
        return sorted(written | set(owned))


def refresh_layers(spark: SparkSession, incoming: DataFrame, roots: Roots, *, run_ts: str,
                   levels: str = "ordered", fill: str = "close") -> None:
    """Stamped bronze rows merged into the layers. With ``fill="future"`` a changed bar can
    close any earlier gap, so the gold of touched instruments is rebuilt from all their bars."""
    with staged(incoming, "incoming") as incoming:
        write_merged(spark, incoming, roots.bronze, buckets=roots.buckets)
        with staged(first_changes(incoming), "starts") as starts:  # one row a touched instrument
            refresh_silver(spark, starts, roots)
            if fill == "close":
                parts = refresh_gold(spark, starts, roots, run_ts=run_ts, levels=levels)
            else:
                parts = _rebuild_gold(spark, starts, roots, run_ts=run_ts, levels=levels, fill=fill)
        if roots.state is not None and parts:
            refresh_state(spark, roots, parts)


def _rebuild_gold(spark: SparkSession, starts: DataFrame, roots: Roots, *, run_ts: str, levels: str,
                  fill: str) -> list[tuple[int, int]]:
    buckets = sorted(_first_months(starts, layout.stored_buckets(spark, roots.silver)))
    silver = without_layout(_silver_table(spark, roots.silver).where(F.col(BUCKET).isin(buckets)))
    silver = silver.join(starts.select("pair"), "pair", "left_semi")
    gold = build_gold(silver.drop("pair"), run_ts=run_ts, levels=levels, fill=fill)
    replace_pairs(with_pair(_valid(gold, "gold")), roots.gold, starts, buckets=roots.buckets)
    if layout.stored_buckets(spark, roots.gold) is None:  # no gap yet
        return []
    buckets = sorted(_first_months(starts, layout.stored_buckets(spark, roots.gold)))
    parts = layout.touched_partitions(
        scan_partitions(spark, roots.gold, schema=GOLD_SCHEMA).where(F.col(BUCKET).isin(buckets)))
    old = [] if roots.state is None or layout.stored_buckets(spark, roots.state) is None else layout.touched_partitions(
        spark.read.parquet(roots.state).where(F.col(BUCKET).isin(buckets)))
    return sorted(set(parts) | set(old))


def run_refresh(spark: SparkSession, raw_root: str, roots: Roots, *, run_ts: str,
                levels: str = "ordered", fill: str = "close") -> None:
    """One landed delivery -> all layers."""
    raw = scan_raw_json(spark, raw_root).drop("pair")
    if not raw.isEmpty():
        refresh_layers(spark, stamp_ingest(raw, run_ts), roots, run_ts=run_ts, levels=levels, fill=fill)


def volatility_since(silver: DataFrame, starts: DataFrame, days: int = 20) -> DataFrame:
    """``rolling_volatility`` of the touched instruments' bars from their first changed day on,
    computed from these bars and ``days - 1`` halo rows before them."""
    keyed = with_pair(silver)
    later = keyed.join(starts.select("pair", "start"), "pair").where("date >= start").drop("start")
    bars = later.unionByName(bars_before(keyed, starts, days - 1)) if days > 1 else later
    rolled = rolling_volatility(bars, days, name=f"volatility_{days}d").join(starts.select("pair", "start"), "pair")
    return rolled.where("date >= start").drop("start", *([] if "pair" in silver.columns else ["pair"]))


# -- mergeable report state ----------------------------------------------------

def report_state(gold: DataFrame) -> DataFrame:
    """Counts, sums and maxima of the gaps of each instrument, month (``date``, its first day)
    and type. Adding up states of disjoint sets of gaps gives the state of all of them."""
    size = F.abs(F.col("fvg_size_pips"))
    return gold.groupBy(*PAIR, F.trunc("date", "month").alias("date"), "fvg_type").agg(
        F.count(F.lit(1)).alias("total"), F.sum("is_filled").alias("filled"), F.count(size).alias("sized"),
        F.sum(size).cast("decimal(24,2)").alias("size_sum"), F.max(size).alias("size_max"))


def refresh_state(spark: SparkSession, roots: Roots, parts: list[tuple[int, int]]) -> None:
    """The state of the gold partitions ``parts`` computed anew; all other state stays."""
    gold = without_layout(layout.in_partitions(scan_partitions(spark, roots.gold, schema=GOLD_SCHEMA), parts))
    n = layout.stored_buckets(spark, roots.state)
    if n is None:
        n = layout.stored_buckets(spark, roots.gold)
    replace_partitions(with_pair(report_state(gold)), roots.state, parts, n_buckets=n)


def state_fill_rate(state: DataFrame) -> DataFrame:
    """``report_fill_rate`` from the state."""
    from candlegap.plans.reports import percent

    total, filled = F.sum("total"), F.sum("filled")
    return (state.groupBy("fvg_type").agg(
        total.alias("total_fvgs"), filled.alias("filled_count"), (total - filled).alias("unfilled_count"),
        percent(filled, total).alias("fill_rate_pct")).orderBy(F.col("fill_rate_pct").desc(), "fvg_type"))


def state_monthly_activity(state: DataFrame, *, by_pair: bool = True) -> DataFrame:
    """``report_monthly_activity`` from the state."""
    def of(kind: str):
        return F.sum(F.when(F.col("fvg_type") == kind, F.col("total")).otherwise(0))

    # to six places first, as the mean of decimal(10,2) values has
    mean = F.round(F.sum("size_sum") / F.sum("sized"), 6).cast("decimal(14,6)")
    keys = (PAIR if by_pair else []) + [F.date_trunc("month", "date").alias("month")]
    return (state.groupBy(*keys).agg(
        F.sum("total").alias("total_fvgs"), of("bullish").alias("bullish_fvgs"), of("bearish").alias("bearish_fvgs"),
        F.round(mean, 2).cast("decimal(10,2)").alias("avg_size_pips"),
        F.max("size_max").cast("decimal(10,2)").alias("max_size_pips"),
    ).orderBy(F.col("month").desc(), *(PAIR if by_pair else [])))


def state_summary(state: DataFrame) -> DataFrame:
    """``gap_summary`` from the state."""
    def total(what):
        return F.coalesce(F.sum(what), F.lit(0).cast("long"))

    return state.agg(
        total(F.col("total")).alias("total_fvgs"),
        total(F.when(F.col("fvg_type") == "bullish", F.col("total"))).alias("bullish_fvgs"),
        total(F.when(F.col("fvg_type") == "bearish", F.col("total"))).alias("bearish_fvgs"),
        total(F.col("filled")).alias("filled_fvgs"),
        total(F.col("total") - F.col("filled")).alias("unfilled_fvgs"))
