"""Structured Streaming form of the layer jobs (incremental refresh)."""

from candlegap.streaming.refresh import refresh_batch, start_refresh

__all__ = ["refresh_batch", "start_refresh"]
