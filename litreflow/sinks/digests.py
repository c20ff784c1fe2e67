"""Which days of a source have changed, however old: digests beside the target.

An incremental run that goes by a high-water mark misses rows that arrive,
change or vanish behind it. Here every source file is summed up by a few
numbers per day that do not depend on the order of rows,

    n rows, the xor of two 64-bit hashes, the sum of two 31-bit hashes,

which are kept with the target's version. A run reads the files that are new or
were rewritten since (by path, time and size), takes the others' numbers from
the last run, and compares each day's total with the one before. Days that
differ are rebuilt whole from the source: added, corrected and deleted rows are
all seen, and nothing is said about days that are the same.

Target and digests change in one step (``sinks.live``); digests are taken before
the rows are read, so rows that arrive in between are seen again by the next
run. Two sets of rows with equal numbers are taken as equal. Only the source
itself is watched: a change in a table that the model joins to it needs a full
run (``full=True``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litreflow.sinks import live
from litreflow.sinks.incremental import _one_row_per_key, _publish, month_of

_FILE = ["file", "changed_at", "size"]
_MEASURES = ["n", "x1", "x2", "s1", "s2"]
#: More changed files than this are not named to the scan: all are read.
MOST_FILES = 10_000


@dataclass(frozen=True)
class Rebuilt:
    mode: str            # "full" or "days"
    days: list           # the rebuilt days, None for rows without a day
    files_read: int      # source files whose digests were taken
    version: int         # of the target


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a row; a null counts, and counts where it is."""
    values = [F.col(f"`{c}`") for c in columns]
    present = F.concat(*[F.when(v.isNull(), "0").otherwise("1") for v in values])
    return [F.xxhash64(*values, present), F.xxhash64(F.lit("second"), present, *reversed(values))]


def _measures(columns: Sequence[str]) -> list[Column]:
    a, b = _row_hashes(columns)
    low = (1 << 31) - 1  # sums stay exact up to 2**32 rows a day and file
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(a).alias("x1"), F.bit_xor(b).alias("x2"),
            F.sum(a.bitwiseAND(low)).alias("s1"), F.sum(b.bitwiseAND(low)).alias("s2")]


def _summed(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.groupBy(*by).agg(F.sum("n").alias("n"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"),
                                  F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))


def day_digests(rows: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """day, n, x1, x2, s1, s2 over any rows."""
    return rows.groupBy(day.alias("day")).agg(*_measures(columns))


def _files(source: DataFrame) -> list[Column]:
    return [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("changed_at"),
            F.col("_metadata.file_size").alias("size")]


def file_digests(source: DataFrame, day: Column, columns: Sequence[str]) -> DataFrame:
    """day_digests of each file of a file source: file, changed_at, size too."""
    return source.groupBy(*_files(source), day.alias("day")).agg(*_measures(columns))


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """day: those of which the numbers differ, or that only one side has."""
    a, b = before.alias("a"), after.alias("b")
    same = F.lit(True)
    for c in _MEASURES:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = a.join(b, F.col("a.day").eqNullSafe(F.col("b.day")), "full")
    return joined.filter(~same).select(F.coalesce("a.day", "b.day").alias("day"))


def _refreshed(source: DataFrame, day: Column, columns: Sequence[str], held: DataFrame) -> tuple[DataFrame, int]:
    """File digests now: those held for files that are as they were, and new
    ones. Which files there are is read from their footers."""
    now = source.select(*_files(source)).distinct()
    known = held.select(*_FILE).distinct()
    new = [r["file"] for r in now.join(known, _FILE, "left_anti").select("file").limit(MOST_FILES + 1).collect()]
    if len(new) > MOST_FILES:
        return file_digests(source, day, columns), len(new)
    kept = held.join(now, _FILE, "left_semi")
    if not new:
        return kept, 0
    # the names reach the scan, which leaves the other files out
    fresh = file_digests(source.filter(F.col("_metadata.file_path").isin(new)), day, columns)
    return kept.unionByName(fresh), len(new)


def rebuild_changed_days(spark: SparkSession, source: DataFrame, day: Column,
                         build: Callable[[list | None], DataFrame], target_path: str, keys: Sequence[str],
                         day_column: str, partition_col: str = "month",
                         partition_expr: Callable[[str], Column] = month_of,
                         columns: Sequence[str] | None = None, cluster_by: Sequence[str] = (),
                         full: bool = False) -> Rebuilt:
    """Bring the live table at ``target_path`` up to date with ``source``.

    ``day`` gives the day of a source row and ``day_column`` is the target's
    column of that day. ``build(days)`` returns the model's rows of these days
    (None: all), one for each of ``keys``. ``columns`` are the source columns
    that the model reads (all). The driver gets the names of changed files and
    the changed days, a calendar's worth at most.
    """
    columns = list(columns or source.columns)
    held = live.snapshot(spark, target_path)
    digests = f"{target_path}/digests/{uuid.uuid4().hex[:12]}"
    if held is None or full or "digests" not in held.extra:
        file_digests(source, day, columns).write.mode("overwrite").parquet(digests)
        files = spark.read.parquet(digests).select("file").distinct().count()
        rows = build(None).withColumn(partition_col, partition_expr(day_column))
        done = _publish(spark, _one_row_per_key(rows, keys), target_path, held, partition_col, cluster_by, None,
                        {"digests": digests})
        return Rebuilt("full", [], files, done.version)

    before = spark.read.parquet(held.extra["digests"])
    now, files = _refreshed(source, day, columns, before)
    now.write.mode("overwrite").parquet(digests)
    after = spark.read.schema(before.schema).parquet(digests)
    by_day = [_summed(x, ["day"]) for x in (before, after)]
    days = sorted((r["day"] for r in changed_days(*by_day).collect()), key=lambda d: (d is None, d))
    if not days:
        done = live.publish(spark, target_path, held, held.schema, [], {}, {"digests": digests})
        return Rebuilt("days", [], files, done.version)
    rows = _one_row_per_key(build(days).withColumn(partition_col, partition_expr(day_column)), keys)
    # the touched partitions: of the changed days, a list as short as theirs
    parts = spark.createDataFrame([(d,) for d in days], f"`{day_column}` {before.schema['day'].dataType.simpleString()}")
    folders = [live.folder_of(partition_col, r[0])
               for r in parts.select(partition_expr(day_column).cast("string")).distinct().collect()]
    known = [d for d in days if d is not None]
    stays = ~F.coalesce(F.col(day_column).isin(known), F.lit(False)) if known else F.lit(True)
    if None in days:
        stays = stays & F.col(day_column).isNotNull()
    kept = live.read_snapshot(spark, target_path, held, folders).filter(stays)
    merged = kept.unionByName(rows.select(*kept.columns))
    done = _publish(spark, merged, target_path, held, partition_col, cluster_by, folders, {"digests": digests})
    return Rebuilt("days", days, files, done.version)
