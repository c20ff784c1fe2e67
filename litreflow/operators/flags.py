"""Existence flags and union helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litreflow.operators.dedupe import distinct_keys


def existence_flag(left: DataFrame, right: DataFrame, on: Sequence,
                   name: str) -> DataFrame:
    """Add ``name = (a matching right row exists)`` to every left row.

    The right side is reduced to its distinct keys first, so the left join
    cannot fan out (``CASE WHEN r.key IS NOT NULL THEN TRUE ELSE FALSE``
    after a left join to a key-deduped right side). ``on`` lists shared key
    names or ``(left_column, right_column)`` pairs. A NULL key never matches.
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    marker = f"__ef_{name}"
    keys = distinct_keys(right, [rk for _, rk in pairs])
    keys = keys.select(*[F.col(rk).alias(f"__ef_k{i}") for i, (_, rk) in enumerate(pairs)],
                       F.lit(True).alias(marker))
    cond = [left[lk] == keys[f"__ef_k{i}"] for i, (lk, _) in enumerate(pairs)]
    out = left.join(keys, cond, "left")
    return out.select(*[left[c] for c in left.columns],
                      F.coalesce(F.col(marker), F.lit(False)).alias(name))


def union_with_typed_nulls(branches: Sequence[DataFrame],
                           columns: Sequence[tuple[str, str]]) -> DataFrame:
    """``UNION ALL`` of branches over one column list; a column a branch does
    not have becomes ``CAST(NULL AS type)`` and every column is cast to the
    declared type, so the branches line up by name and type."""
    out = None
    for df in branches:
        have = set(df.columns)
        sel = [(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns]
        part = df.select(*sel)
        out = part if out is None else out.unionByName(part)
    return out


#: Rows of a lookup of a few columns that are surely under 64 MB.
FEW_ROWS = 200_000


def are_few(lookup: DataFrame, rows: int = FEW_ROWS) -> bool:
    """Whether there are no more than ``rows``; the count stops after them."""
    return lookup.limit(rows + 1).count() <= rows


def broadcast_if_few(lookup: DataFrame, rows: int = FEW_ROWS) -> DataFrame:
    """``lookup``, to be broadcast if it has been counted to be small.

    Estimates come from file sizes, so the planner shuffles a wide fact for a
    lookup that filters have made small, and all rows of a frequent key go to
    one task. The count stops after ``rows`` rows; a larger lookup stays as it is."""
    return F.broadcast(lookup) if are_few(lookup, rows) else lookup
