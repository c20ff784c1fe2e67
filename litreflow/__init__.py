"""litreflow: fuel-operations marts on Spark.

Reusable DataFrame operators (latest row per key, validity-range join,
conditional pivot, two-sided ledger, existence flags, zero-fallback chains,
split-load collection, settlement dates, keyed incremental merge) composed
into the marts, plus data-quality checks that run as Spark aggregations.
"""

from litreflow.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
