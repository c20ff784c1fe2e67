"""Incremental daily litres on the benchmark tables.

The source grows in two steps: first the transactions shipped before
``SPLIT_DATE``, then all of them. The mart is built into a month-partitioned
table in the shared folder by two runs of the incremental merge -- a first
(full) run and an incremental run after the source grew -- and then read back.
The result equals the full load.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litreflow.plans.analogs import _daily_transactions, daily_quantity_from
from litreflow.session import shared_dir
from litreflow.sinks.incremental import merge_by_partition_rewrite
from litreflow.sources.tables import DriverTables, tables_for
from litreflow.streaming import start_day_rebuild_stream

SPLIT_DATE = "1998-06-01"   # fixed value: where the first source snapshot ends
KEYS = ["ship_date", "customer_id", "provider_id", "supply_site_id"]
OUTPUT = ["ship_date", "customer_id", "provider_id", "supply_site_id", "depot",
          "customer", "litres"]


def daily_quantity_incremental(spark: SparkSession, sf_dir: str,
                               target_path: str | None = None) -> DataFrame:
    t = tables_for(spark, sf_dir)
    target = target_path or f"{shared_dir(spark)}/litreflow-marts/daily_quantity/{uuid.uuid4().hex}"

    def source_until(split):
        def build(mark):
            # the incremental filter is applied to the source scan
            return daily_quantity_from(_daily_transactions(t, since=mark, until=split), t)
        return build

    kw = dict(keys=KEYS, mark_column="ship_date", cluster_by=["customer_id", "supply_site_id"])
    merge_by_partition_rewrite(spark, source_until(SPLIT_DATE), target, **kw)
    merge_by_partition_rewrite(spark, source_until(None), target, **kw)
    return spark.read.parquet(target).select(*OUTPUT)


def consecutive(days: list[dt.date], most: int = 64) -> list[tuple[dt.date, dt.date]]:
    """First and last day of each run of consecutive days; the shortest gaps
    are bridged where there would be more than ``most`` runs."""
    days = sorted(days)
    gaps = sorted(((b - a).days, i) for i, (a, b) in enumerate(zip(days, days[1:])) if (b - a).days > 1)
    cuts = sorted(i + 1 for _, i in gaps[max(0, len(gaps) - most + 1):])
    return [(days[a], days[b - 1]) for a, b in zip([0, *cuts], [*cuts, len(days)])]


def daily_quantity_stream(spark: SparkSession, sf_dir: str,
                          target_path: str | None = None) -> DataFrame:
    """Daily litres kept current from a file stream of transactions.

    lineitem is read as a Structured Streaming file source; each
    micro-batch names the ship days it touched, those days are rebuilt from
    the whole source (bounds on the raw timestamp reach the scan) and merged
    into the month-partitioned target by key. The target, read back, equals
    the full load.
    """
    t = tables_for(spark, sf_dir)
    base = shared_dir(spark)
    run = uuid.uuid4().hex
    target = target_path or f"{base}/litreflow-marts/daily_quantity_stream/{run}"

    def rebuild(days):
        # a fresh scan: files that came after the stream started are in it.
        # Runs of consecutive days are pushed to it, so one late row from
        # years back does not widen the range that is read.
        now = DriverTables(spark, sf_dir)
        tx = None
        for lo, hi in consecutive(days):
            part = _daily_transactions(now, since=lo, until=hi + dt.timedelta(days=1))
            tx = part if tx is None else tx.unionByName(part)
        return daily_quantity_from(tx, now)

    q = start_day_rebuild_stream(
        spark, f"{t.sf_dir}/lineitem.parquet*", t.lineitem.schema,
        lambda df: F.to_date(df["l_shipdate"]), rebuild, target, KEYS, "ship_date",
        name=f"daily_quantity_{run[:8]}", cluster_by=["customer_id", "supply_site_id"],
        checkpoint=f"{base}/litreflow-streams/{run}", reader_options={"basePath": t.sf_dir})
    q.awaitTermination()
    return spark.read.parquet(target).select(*OUTPUT)
