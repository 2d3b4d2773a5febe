"""Keyed upsert and schema evolution, as plain DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlegap.functions.columns import BAR_KEYS
from candlegap.operators.quality import dedup_latest


def evolve_schema(*frames: DataFrame) -> DataFrame:
    """Union batches by column name; a column missing from a batch is NULL
    there. Column order: the first batch's, then new columns as they appear.
    """
    if not frames:
        raise ValueError("evolve_schema needs at least one frame")
    out = frames[0]
    for nxt in frames[1:]:
        out = out.unionByName(nxt, allowMissingColumns=True)
    return out


def upsert_bars(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str] = BAR_KEYS,
    order: Sequence[str] = ("_ingest_timestamp",),
) -> DataFrame:
    """Keyed merge (MERGE ... WHEN MATCHED UPDATE / NOT MATCHED INSERT): for a
    key present in both, the incoming row replaces the existing one; keys
    only in one side are kept. Copies of a key inside one side are resolved
    by the latest ``order`` (then the other columns, as in ``dedup_latest``).

    Written as union + ``dedup_latest``: a single aggregation whose partial
    step collapses copies map-side, so neither side needs its own shuffle
    and a hot key never lands whole in one task. Applying the same incoming
    batch twice gives the same table (idempotent). Schemas are unioned by
    name, so an incoming batch may add columns.

    The result must be written to a different path than ``existing`` is
    read from (Spark refuses to overwrite a path a plan still reads).
    """
    tagged_old = existing.withColumn("_upsert_side", F.lit(0))
    tagged_new = incoming.withColumn("_upsert_side", F.lit(1))
    both = evolve_schema(tagged_old, tagged_new)
    picked = dedup_latest(both, keys, order=("_upsert_side", *order))
    return picked.drop("_upsert_side")
