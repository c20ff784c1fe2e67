"""A stream of new transaction files keeps daily litres equal to a full
rebuild, including a late row that the high-water-mark run would miss."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from fixtures import fuel_row, registry
from litreflow.constants import NIL_GUID
from litreflow.plans import fuelcard
from litreflow.session import shared_dir
from litreflow.sources.schemas import SCHEMAS
from litreflow.streaming import start_day_rebuild_stream

D = dt.datetime
FT = ("tfn_data_historical", "fuel_transactions")


def test_stream_rebuilds_touched_days(spark):
    base = f"{shared_dir(spark)}/tests-stream/{uuid.uuid4().hex}"
    src_dir, target = f"{base}/source", f"{base}/target"
    src = registry(spark)
    first = src.source(*FT)
    first.write.mode("append").parquet(src_dir)
    src.put(*FT, spark.read.schema(SCHEMAS[FT]).parquet(src_dir))

    def rebuild(days):
        full = fuelcard.data_tool(src)
        return full.filter(F.col("Date").isin(days))

    def run():
        q = start_day_rebuild_stream(
            spark, src_dir, SCHEMAS[FT], lambda df: F.to_date(df["CapturedDate"]), rebuild,
            target, fuelcard.DATA_TOOL_KEYS, "Date", name=f"s{uuid.uuid4().hex[:8]}",
            checkpoint=f"{base}/ckpt")
        q.awaitTermination(120)

    def rows(df):
        return sorted((r.Date, r.ServiceProviderID or "", r.LitreAmount) for r in df.collect())

    run()
    assert rows(spark.read.parquet(target).drop("month")) == rows(fuelcard.data_tool(src))
    late = spark.createDataFrame([fuel_row(
        FuelTransactionID="late", TFNCustomerID="T1", CustomerID="c1", ServiceProviderID=NIL_GUID,
        SupplySiteID="s1", CapturedDate=D(2025, 3, 1, 21), LitreAmount=2.0)], SCHEMAS[FT])
    late.write.mode("append").parquet(src_dir)
    src.put(*FT, spark.read.schema(SCHEMAS[FT]).parquet(src_dir))
    run()
    got = rows(spark.read.parquet(target).drop("month"))
    assert got == rows(fuelcard.data_tool(src))
    assert (dt.date(2025, 3, 1), NIL_GUID, 17.0) in got


def test_days_are_read_in_runs():
    import datetime as dt
    from litreflow.plans.incremental_demo import consecutive
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    assert consecutive([day(5), day(0), day(1), day(6)]) == [(day(0), day(1)), (day(5), day(6))]
    assert consecutive([day(3)]) == [(day(3), day(3))]
    many = consecutive([day(n * n) for n in range(100)], most=4)
    assert len(many) == 4 and many[0][0] == day(0) and many[-1][1] == day(99 * 99)
    assert all(a[1] < b[0] for a, b in zip(many, many[1:]))
