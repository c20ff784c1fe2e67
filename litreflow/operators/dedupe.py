"""Keep one row per key (``ROW_NUMBER() OVER (PARTITION BY k ORDER BY o) = 1``).

Spark plans ``row_number() = 1`` as WindowGroupLimit: a partial limit on the
map side keeps at most one row per key and task *before* the shuffle, then a
final limit after it. A key holding a third of all rows therefore shuffles
one row per map task, not a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

_RN = "__lf_rn"


def _sortable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (ArrayType, MapType, StructType))


def default_tie_break(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """All non-key columns ascending (NULLs first): a total order over the
    output, so the kept row is the same on every run."""
    return [F.col(c).asc_nulls_first() for c in df.columns
            if c not in keys and _sortable(df, c)]


def latest_per_key(df: DataFrame, keys: Sequence[str | Column],
                   order: Sequence[Column],
                   tie_break: Sequence[Column] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order`` then ``tie_break``.

    ``order`` holds sort expressions such as ``F.col("ExpiryDate").desc()``
    (DESC puts NULLs last, ASC first, as in the source SQL dialect). Rows that
    tie on ``order`` are resolved by ``tie_break`` -- by default every
    remaining column ascending -- so results are repeatable. NULL keys form
    one group, as in SQL window partitions.
    """
    key_names = [k for k in keys if isinstance(k, str)]
    if tie_break is None:
        tie_break = default_tie_break(df, key_names)
    w = Window.partitionBy(*keys).orderBy(*order, *tie_break)
    cols = df.columns
    return (df.select("*", F.row_number().over(w).alias(_RN))
            .filter(F.col(_RN) == 1)
            .select(*cols))


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key when only the key's existence is used (partial
    aggregation on the map side, then one shuffle)."""
    return df.select(*keys).dropDuplicates(list(keys))
