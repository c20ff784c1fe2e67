"""Reusable DataFrame -> DataFrame operators the marts are made of."""

from litreflow.operators.aggregates import (
    collect_and_flag,
    conditional_pivot,
    two_sided_ledger,
)
from litreflow.operators.dedupe import distinct_keys, latest_per_key
from litreflow.operators.flags import are_few, broadcast_if_few, existence_flag, union_with_typed_nulls
from litreflow.operators.settlement import payment_aggregates, settlement_date
from litreflow.operators.validity import newest_valid, validity_join

__all__ = [
    "are_few",
    "broadcast_if_few",
    "collect_and_flag",
    "conditional_pivot",
    "distinct_keys",
    "existence_flag",
    "latest_per_key",
    "newest_valid",
    "payment_aggregates",
    "settlement_date",
    "two_sided_ledger",
    "union_with_typed_nulls",
    "validity_join",
]
