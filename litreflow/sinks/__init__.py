"""Materialization: views, tables, partitioned tables, incremental merge,
tables that change in one step, rebuilding of changed days."""

from litreflow.sinks.digests import Rebuilt, rebuild_changed_days
from litreflow.sinks.incremental import MergeResult, merge_by_partition_rewrite, month_of
from litreflow.sinks.live import read_live, register_live, remove_unused
from litreflow.sinks.writers import (
    database_for,
    register_table,
    write_bucketed,
    write_table,
)

__all__ = [
    "MergeResult",
    "Rebuilt",
    "database_for",
    "merge_by_partition_rewrite",
    "month_of",
    "read_live",
    "rebuild_changed_days",
    "register_live",
    "register_table",
    "remove_unused",
    "write_bucketed",
    "write_table",
]
