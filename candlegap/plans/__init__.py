"""Composite plans: the layer jobs and the reports."""

from candlegap.plans import pipeline, reports
from candlegap.plans.pipeline import (
    build_gold,
    build_silver,
    layer_row_counts,
    merge_into_bronze,
    run_bronze,
    run_documents,
    run_gold,
    run_silver,
    stamp_ingest,
)

__all__ = ["build_gold", "build_silver", "layer_row_counts", "merge_into_bronze", "pipeline", "reports",
           "run_bronze", "run_documents", "run_gold", "run_silver", "stamp_ingest"]
