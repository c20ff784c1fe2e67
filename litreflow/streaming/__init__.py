"""Incremental marts fed by a file stream (micro-batches rebuild the days
they touch and merge them by key)."""

from litreflow.streaming.incremental_stream import start_day_rebuild_stream

__all__ = ["start_day_rebuild_stream"]
