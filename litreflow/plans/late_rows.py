"""Daily litres under late, corrected and withdrawn transactions.

The source is written as one folder a year. Its first state lacks some old
rows, has others with a wrong quantity and some that do not belong there; then
the years concerned are rewritten as they should be. The mart is built in full
from the first state and brought up to date by the days whose digests changed.
The result equals the full load of the right source.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litreflow.plans.analogs import _daily_transactions, daily_quantity_from
from litreflow.plans.incremental_demo import KEYS, OUTPUT, consecutive
from litreflow.session import shared_dir
from litreflow.sinks import Rebuilt, read_live, rebuild_changed_days
from litreflow.sources.tables import DriverTables, tables_for

#: What a transaction has; the digests are of these columns.
COLUMNS = ["l_orderkey", "l_suppkey", "l_linestatus", "l_returnflag", "l_shipdate", "l_quantity"]

# --- fixed values: what is wrong in the first state --------------------------
MISSING = "l_shipdate >= '1995-03-01' AND l_shipdate < '1995-03-09' AND l_orderkey % 3 = 0"
WRONG = "l_shipdate >= '1996-05-10' AND l_shipdate < '1996-05-13' AND l_suppkey % 2 = 0"
WITHDRAWN = "l_shipdate >= '1996-11-01' AND l_shipdate < '1996-11-02'"   # had each row twice
REPAIRED_YEARS = (1995, 1996)
# --- end of fixed values ------------------------------------------------------


def _first_state(rows: DataFrame) -> DataFrame:
    wrong = F.expr(WRONG)
    return (rows.filter(~F.expr(MISSING))
            .withColumn("l_quantity", F.when(wrong, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
                        .cast(rows.schema["l_quantity"].dataType))
            .unionByName(rows.filter(WITHDRAWN)))


class _Changing(DriverTables):
    """The tables, lineitem from a folder that changes."""

    def __init__(self, spark: SparkSession, sf_dir: str, folder: str):
        super().__init__(spark, sf_dir)
        self._folder = folder

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._folder) if name == "lineitem" else super().get(name)


def _of_days(t: DriverTables, days: list | None) -> DataFrame:
    """The mart's rows of these days: runs of days are bounds on the scan."""
    if days is None:
        return daily_quantity_from(_daily_transactions(t), t)
    rows = None
    for lo, hi in consecutive(days):
        part = _daily_transactions(t, since=lo).filter(F.col("ship_date") <= F.lit(hi))
        rows = part if rows is None else rows.unionByName(part)
    wanted: Column = F.col("ship_date").isin(days)
    return daily_quantity_from(rows.filter(wanted), t)


def repaired(spark: SparkSession, sf_dir: str) -> tuple[str, Rebuilt, Rebuilt]:
    """Both runs; the target's path and what each has rebuilt."""
    base = f"{shared_dir(spark)}/litreflow-marts/late/{uuid.uuid4().hex}"
    folder, target = f"{base}/source", f"{base}/daily_quantity"
    year = F.year("l_shipdate").alias("year")
    right = tables_for(spark, sf_dir).lineitem.select(*COLUMNS, year)

    def put(rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(folder)

    def run() -> Rebuilt:
        now = _Changing(spark, sf_dir, folder)
        return rebuild_changed_days(
            spark, now.lineitem, F.to_date("l_shipdate"), lambda days: _of_days(now, days), target, KEYS, "ship_date",
            columns=COLUMNS, cluster_by=["customer_id", "supply_site_id"])

    put(_first_state(right))
    first = run()
    put(right.filter(F.col("year").isin(*REPAIRED_YEARS)))
    return target, first, run()


def daily_quantity_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after the repair."""
    return read_live(spark, repaired(spark, sf_dir)[0]).select(*OUTPUT)


def late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that the repair has rebuilt."""
    return spark.createDataFrame([(d,) for d in repaired(spark, sf_dir)[2].days], "ship_date date")


LATE_DAYS_SQL = f"""
SELECT DISTINCT CAST(l_shipdate AS DATE) AS ship_date FROM lineitem
WHERE ({MISSING}) OR ({WRONG}) OR ({WITHDRAWN})
"""
