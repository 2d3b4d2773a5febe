"""Incremental bronze -> silver -> gold refresh as a Structured Streaming job.

The raw zone is a file source: every new JSON file under ``raw_root`` is
picked up once (tracked in the checkpoint). Each micro-batch, stamped with its start instant, goes
through ``plans.incremental.refresh_layers``: merged into the (bucket, month) partitions of bronze
that it touches, later deliveries of a day winning; silver and gold recomputed from each
instrument's first changed day with halo rows before it; and the report state, where one is kept,
replaced for the gold partitions that were rewritten.

Other partitions' files are never rewritten, and a replayed batch merges the
same records again, which changes nothing. The checkpoint lives under the
session's shared checkpoint folder unless given, so a restarted driver
resumes where the last committed batch ended.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from candlegap.plans.incremental import Roots, refresh_layers
from candlegap.plans.pipeline import stamp_ingest
from candlegap.schemas import BRONZE_SCHEMA
from candlegap.sinks.layout import DEFAULT_BUCKETS
from candlegap.sinks.paths import scratch_path


def refresh_batch(batch: DataFrame, batch_id: int, *, roots: Roots, levels: str = "ordered",
                  fill: str = "close") -> None:
    """One micro-batch of raw records -> all layers. Safe to run again for the same ``batch_id``."""
    if batch.isEmpty():
        return
    # one instant per batch, so bronze and silver carry the same stamp
    run_ts = datetime.now(timezone.utc).isoformat()
    refresh_layers(batch.sparkSession, stamp_ingest(batch, run_ts), roots, run_ts=run_ts, levels=levels, fill=fill)


def start_refresh(
    spark: SparkSession,
    raw_root: str,
    bronze_root: str,
    silver_root: str,
    gold_root: str,
    state_root: str | None = None,
    *,
    checkpoint: str | None = None,
    available_now: bool = True,
    multi_line: bool = False,
    max_files_per_trigger: int | None = None,
    levels: str = "ordered",
    fill: str = "close",
    buckets: int = DEFAULT_BUCKETS,
) -> StreamingQuery:
    """Start the refresh stream. ``available_now`` processes what has landed
    and stops (a scheduled incremental run); otherwise it keeps watching."""
    reader = (spark.readStream.schema(BRONZE_SCHEMA)
              .option("multiLine", str(multi_line).lower()))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.json(raw_root)

    roots = Roots(bronze_root, silver_root, gold_root, state_root, buckets)

    def _each(batch: DataFrame, batch_id: int) -> None:
        refresh_batch(batch, batch_id, roots=roots, levels=levels, fill=fill)

    writer = (raw.writeStream.foreachBatch(_each)
              .option("checkpointLocation", checkpoint or scratch_path(spark, "refresh-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
