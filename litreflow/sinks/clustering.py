"""Tables clustered by several keys at once.

Sorted by (customer, provider, site), a table prunes reads by customer only. On
a space-filling order each key is put in one of ``2 ** bits`` ranges of about
equally many values, and rows are sorted by the interleaved bits of all keys'
ranges: rows that lie near each other in every key lie near each other in the
files, so the min/max of a row group is narrow for every key. Bloom filters in
the footers rule out row groups whose range holds a value that they do not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges of a key, as a power of two.
BITS = 5


def _ranges(df: DataFrame, column: str, bits: int, name: str) -> DataFrame:
    """Each value of a key and the number of its range: the values, not the
    rows, are dealt into ranges, so a hot value takes no more than its own."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    dealt = values.repartitionByRange(1 << bits, column).withColumn(f"{name}_part", F.spark_partition_id())
    return dealt.select(F.col(column).alias(f"{name}_of"), F.col(f"{name}_part").alias(name))


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """One number with the bits of all, the highest of each first."""
    out = []
    for i in range(bits):
        for j, number in enumerate(numbers):
            bit = F.shiftright(number, i).bitwiseAND(1).cast("bigint")
            out.append(F.shiftleft(bit, i * len(numbers) + len(numbers) - 1 - j))
    return reduce(lambda a, b: a.bitwiseOR(b), out)


def clustered(df: DataFrame, keys: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` in ``files`` partitions on the space-filling order of
    ``keys`` (a null key lies before all values)."""
    out, names = df, []
    for i, key in enumerate(keys):
        name = f"__z{i}"
        names.append(name)
        out = out.join(_ranges(df, key, bits, name), F.col(key) == F.col(f"{name}_of"), "left").drop(f"{name}_of")
    order = out.withColumn("__z", interleaved([F.coalesce(F.col(n), F.lit(0)) for n in names], bits))
    # rows of one place on the order may be many: the keys spread them
    return (order.repartitionByRange(files, "__z", *keys).sortWithinPartitions("__z", *keys)
            .drop("__z", *names))


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int, bits: int = BITS,
                    row_group_rows: int | None = None) -> None:
    """Full rebuild of a Parquet table clustered by ``keys``, with Bloom filters
    of them in the footers."""
    w = clustered(df, keys, files, bits).write.mode("overwrite").option("partitionOverwriteMode", "static")
    for key in keys:
        w = w.option(f"parquet.bloom.filter.enabled#{key}", "true")
    if row_group_rows is not None:
        w = w.option("parquet.block.row.count.limit", row_group_rows)
    w.parquet(path)
