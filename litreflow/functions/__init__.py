"""Column-level helpers: every one returns a Spark ``Column`` built from
built-in functions, so it stays inside whole-stage code generation."""

from litreflow.functions.scalar import (
    calendar_day_diff,
    flag_is_false,
    greater_or_second,
    half_up_ratio,
    is_after,
    first_non_null,
    snap_to_day,
    spread_null_ids,
    spread_nulls,
    substitute_key,
    waterfall,
    zero_fallback,
)

__all__ = [
    "calendar_day_diff",
    "flag_is_false",
    "greater_or_second",
    "half_up_ratio",
    "is_after",
    "first_non_null",
    "snap_to_day",
    "spread_null_ids",
    "spread_nulls",
    "substitute_key",
    "waterfall",
    "zero_fallback",
]
