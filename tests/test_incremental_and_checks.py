"""Incremental merge (first run, boundary rerun, NULL keys, late rows,
duplicate keys), the checks, and the scheduled job."""

import datetime as dt
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from fixtures import fuel_row, registry
from litreflow.checks import Check, failed_errors, run_checks
from litreflow.constants import NIL_GUID
from litreflow.plans import fuelcard
from litreflow.plans.job import run_tagged
from litreflow.session import shared_dir
from litreflow.sinks import database_for, merge_by_partition_rewrite, write_table
from litreflow.sinks.incremental import read_target
from litreflow.sources.schemas import SCHEMAS

D = dt.datetime


def _target(spark):
    return f"{shared_dir(spark)}/tests/{uuid.uuid4().hex}"


def _merge(spark, src, path):
    return merge_by_partition_rewrite(
        spark, lambda mark: fuelcard.data_tool(src, since=mark), path,
        fuelcard.DATA_TOOL_KEYS, "Date", cluster_by=fuelcard.DATA_TOOL_CLUSTER)


def _rows(spark, path):
    return sorted((r.Date, r.ServiceProviderID or "", r.LitreAmount)
                  for r in spark.read.parquet(path).collect())


def test_incremental_first_run_rerun_and_late_rows(spark):
    src = registry(spark)
    path = _target(spark)
    first = _merge(spark, src, path)
    assert first.mode == "full"
    full = _rows(spark, path)
    assert len(full) == 4
    again = _merge(spark, src, path)                       # boundary day reprocessed
    assert again.mode == "incremental" and again.mark == dt.date(2025, 3, 2)
    assert _rows(spark, path) == full                       # NULL-key row not duplicated
    # new source rows: one on the boundary day, one late (before the mark)
    ft = src.source("tfn_data_historical", "fuel_transactions")
    extra = spark.createDataFrame([
        fuel_row(FuelTransactionID="n1", TFNCustomerID="T2", CustomerID="c3", ServiceProviderID=None,
                 SupplySiteID="s2", CapturedDate=D(2025, 3, 2, 20), LitreAmount=4.0),
        fuel_row(FuelTransactionID="n2", TFNCustomerID="T1", CustomerID="c1",
                 ServiceProviderID=NIL_GUID, SupplySiteID="s1", CapturedDate=D(2025, 3, 1, 20),
                 LitreAmount=50.0)], SCHEMAS[("tfn_data_historical", "fuel_transactions")])
    src.put("tfn_data_historical", "fuel_transactions", ft.unionByName(extra))
    res = _merge(spark, src, path)
    assert res.touched_partitions == ["2025-03"]
    got = _rows(spark, path)
    assert (dt.date(2025, 3, 2), "", 7.0) in got            # boundary day rebuilt: 3 + 4
    assert (dt.date(2025, 3, 1), NIL_GUID, 15.0) in got     # late row ignored (no lookback)
    res = merge_by_partition_rewrite(
        spark, lambda mark: fuelcard.data_tool(src, since=mark), path,
        fuelcard.DATA_TOOL_KEYS, "Date", lookback=dt.timedelta(days=1))
    assert (dt.date(2025, 3, 1), NIL_GUID, 65.0) in _rows(spark, path)   # picked up with lookback
    assert len(_rows(spark, path)) == 4


def test_incremental_rejects_duplicate_batch_keys(spark):
    path = _target(spark)
    rows = [(dt.date(2025, 1, 1), "k", 1.0)]
    schema = "Date date, k string, v double"
    merge_by_partition_rewrite(spark, lambda m: spark.createDataFrame(rows, schema), path,
                               ["Date", "k"], "Date")
    dup = rows + rows
    with pytest.raises(ValueError):
        merge_by_partition_rewrite(spark, lambda m: spark.createDataFrame(dup, schema), path,
                                   ["Date", "k"], "Date")


def test_checks_semantics(spark):
    child = spark.createDataFrame([(1, "a", 0.0), (2, "b", 10.0), (2, None, 10.5), (None, "z", None)],
                                  "id int, parent string, v double")
    parent = spark.createDataFrame([("a",), ("b",)], "key string")
    checks = [Check("m", "id", "not_null"), Check("m", "id", "unique"),
              Check("m", "v", "accepted_range", "warn", 0, 10),
              Check("m", "parent", "relationships", parent="p", parent_column="key")]
    rep = {r.check_name: r for r in run_checks(checks, {"m": child, "p": parent}).collect()}
    assert rep["not_null"].failures == 1
    assert rep["unique"].failures == 1                      # one duplicated value
    assert rep["accepted_range"].failures == 1              # 10.5; bounds inclusive, NULL passes
    assert rep["relationships"].failures == 1               # 'z'; NULL child passes
    assert rep["accepted_range"].severity == "warn" and not rep["accepted_range"].passed
    errors = failed_errors(run_checks(checks, {"m": child, "p": parent}))
    assert errors.count() == 3


def test_namespace_routing():
    assert database_for("dev", "tfn_reports", "scratch") == "scratch"
    assert database_for("prod", "tfn_reports ", "scratch") == "tfn_reports"
    assert database_for("prod", None, "scratch") == "scratch"


def test_daily_run_job(spark):
    src = registry(spark)
    root = tempfile.mkdtemp(prefix="litreflow-job-")
    report = run_tagged(spark, src, root, tag="daily_run", env="dev", default_db="scratch")
    rows = {(r.model, r.column_name, r.check_name): r for r in report.collect()}
    assert rows[("data_tool", "ServiceProviderID", "not_null")].failures == 1   # the NULL provider
    assert rows[("tfn_live_vehicles", "MaxObservedCapacity", "not_null")].failures == 1
    assert rows[("fuel_transactions_all_time", "FuelTransactionID", "unique")].passed
    assert spark.read.parquet(f"{root}/scratch/data_tool").count() == 4
    assert spark.read.parquet(f"{root}/scratch/tfn_orders_with_drivers") \
        .filter(F.col("OrderNumberTitle") == "ON1").count() == 1
    # second scheduled run: both incremental marts take their marks and
    # rebuild the boundary; nothing is duplicated (NULL-safe keys)
    run_tagged(spark, src, root, tag="daily_run", env="dev", default_db="scratch")
    orders = spark.read.parquet(f"{root}/scratch/tfn_orders_with_drivers")
    assert orders.count() == 2
    assert spark.read.parquet(f"{root}/scratch/data_tool").count() == 4


def test_table_mart_partitioned_by_day(spark):
    src = registry(spark)
    root = tempfile.mkdtemp(prefix="litreflow-job-")
    run_tagged(spark, src, root, names=["tfn_precalculated_transactions"], env="dev",
               default_db="scratch")
    df = spark.read.parquet(f"{root}/scratch/tfn_precalculated_transactions")
    assert sorted(r.date for r in df.select("date").distinct().collect()) == \
        [dt.date(2025, 3, 1), dt.date(2025, 3, 2)]


def test_seed_reads_header_only_csv(spark):
    from litreflow.sources.registry import read_seed
    path = tempfile.mkdtemp(prefix="litreflow-seed-") + "/seed.csv"
    with open(path, "w") as fh:
        fh.write("SupplierOrder,monday_item_id,monday_name,SentToMonday,created_at,updated_at\n")
    df = read_seed(spark, path)
    assert df.count() == 0 and df.columns[0] == "SupplierOrder"


def test_empty_target_is_a_first_run(spark):
    path = _target(spark)
    schema = "Date date, k string, v double, month string"
    spark.createDataFrame([], schema).write.mode("overwrite").partitionBy("month").parquet(path)
    rows = [(dt.date(2025, 1, 1), "k", 1.0)]
    res = merge_by_partition_rewrite(
        spark, lambda m: spark.createDataFrame(rows, "Date date, k string, v double"), path,
        ["Date", "k"], "Date")
    assert res.mode == "full"
    assert [(r.k, r.v) for r in spark.read.parquet(path).collect()] == [("k", 1.0)]


def test_full_build_runs_every_mart_and_check(spark):
    from litreflow.plans.job import MARTS
    src = registry(spark)
    root = tempfile.mkdtemp(prefix="litreflow-job-")
    report = run_tagged(spark, src, root, tag=None, env="prod", default_db="analytics")
    rows = report.collect()
    assert len(rows) == sum(len(m.checks) for m in MARTS)
    got = {(r.model, r.column_name, r.check_name): r for r in rows}
    # the loads fan-out repeats LoadName by design: the declared unique check fails
    assert not got[("vw_nto_load", "LoadName", "unique")].passed
    assert got[("nto_wholesale_data", "AdhocFixedVolumeDealID", "unique")].passed
    assert got[("tfn_supplier_manager", "SupplySiteID", "relationships")].passed


def test_written_marts_are_catalog_tables(spark):
    src = registry(spark)
    root = tempfile.mkdtemp(prefix="litreflow-job-")
    run_tagged(spark, src, root, names=["data_tool", "tfn_precalculated_transactions"],
               env="prod", default_db="analytics", catalog=True)
    assert spark.table("tfn_data_historical.data_tool").count() == 4
    assert spark.table("analytics.tfn_precalculated_transactions").count() == 2


def test_rows_without_a_month_are_kept(spark):
    path, schema = _target(spark), "Date date, k string, v double"
    merge = lambda rows: merge_by_partition_rewrite(
        spark, lambda m: spark.createDataFrame(rows, schema), path, ["Date", "k"], "Date")
    merge([(dt.date(2025, 1, 1), "a", 1.0), (None, "n1", 1.0)])
    res = merge([(dt.date(2025, 1, 2), "b", 1.0), (None, "n2", 2.0), (None, "n3", 3.0)])
    assert res.touched_partitions == ["2025-01", None]
    merge([(dt.date(2025, 1, 3), "c", 1.0), (None, "n3", 4.0)])
    got = {(r.k, r.v) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 1.0), ("b", 1.0), ("c", 1.0), ("n1", 1.0), ("n2", 2.0), ("n3", 4.0)}


def test_first_run_rejects_repeated_keys(spark):
    path = _target(spark)
    rows = [(dt.date(2025, 1, 1), "k", 1.0), (dt.date(2025, 1, 1), "k", 2.0)]
    with pytest.raises(Exception, match="several rows for one key"):
        merge_by_partition_rewrite(spark, lambda m: spark.createDataFrame(rows, "Date date, k string, v double"),
                                   path, ["Date", "k"], "Date")
    assert read_target(spark, path) is None                 # nothing was written


def test_rerun_changes_nothing_and_leaves_no_staging(spark):
    path, schema = _target(spark), "Date date, k string, v double"
    rows = [(dt.date(2025, 1, d), f"k{d}", float(d)) for d in range(1, 20)]
    build = lambda m: spark.createDataFrame(rows, schema).filter(
        F.lit(True) if m is None else F.col("Date") >= F.lit(m))
    run = lambda: merge_by_partition_rewrite(spark, build, path, ["Date", "k"], "Date")
    first, again, more = run(), run(), run()
    assert (first.batch_rows, again.batch_rows, more.batch_rows) == (19, 1, 1)
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == sorted((k, v) for _, k, v in rows)
    stage = f"{shared_dir(spark)}/litreflow-stage"
    import os
    assert not os.path.isdir(stage) or os.listdir(stage) == []


def test_full_rebuild_drops_vanished_days(spark):
    path = _target(spark)
    both = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, v int")
    write_table(both, path, ["date"])
    write_table(both.filter("v = 2"), path, ["date"])
    assert [r.v for r in spark.read.parquet(path).collect()] == [2]


def test_unreadable_target_is_not_a_first_run(spark, tmp_path):
    assert read_target(spark, str(tmp_path / "none")) is None
    (tmp_path / "empty").mkdir()
    assert read_target(spark, str(tmp_path / "empty")) is None
    (tmp_path / "damaged").mkdir()
    (tmp_path / "damaged" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        read_target(spark, str(tmp_path / "damaged"))


def test_declared_inputs_are_read(spark, tmp_path):
    """With an empty declared fact, the dashboards have no row."""
    from litreflow.sources.registry import SourceRegistry
    src, root = registry(spark), str(tmp_path)
    for (dataset, table), df in src._frames.items():
        df.write.parquet(f"{root}/{dataset}/{table}")
    name = ("tfn_ops_dashboards", "precalculated_transaction_data_partitioned")
    spark.createDataFrame([], SCHEMAS[name]).write.parquet(f"{root}/{name[0]}/{name[1]}")
    declared = SourceRegistry(spark, root)
    assert declared.has(*name) and not declared.has("tfn_data", "tfn_live_vehicles")
    out = f"{root}-marts"
    run_tagged(spark, declared, out, names=["tfn_supplier_manager"], checked=False)
    assert spark.read.parquet(f"{out}/tfn_ops_dashboards/tfn_supplier_manager").count() == 0
    assert fuelcard.supplier_manager(registry(spark)).count() > 0


def test_every_daily_mart_outlives_the_session(spark, tmp_path):
    from litreflow.plans.job import MARTS
    out = str(tmp_path)
    report = run_tagged(spark, registry(spark), out, tag="daily_run")
    other = spark.newSession()
    for mart in [m for m in MARTS if "daily_run" in m.tags]:
        assert other.read.parquet(f"{out}/{mart.database}/{mart.name}").columns
    assert other.read.parquet(f"{out}/checks_report").count() == report.count() > 0
    with pytest.raises(ValueError):
        run_tagged(spark, registry(spark), out, names=["no_such_mart"])


def test_checks_deal_keys_out_before_they_are_counted(spark):
    """No task counts all keys of its input: 40,000 keys of one input task are
    counted in as many parts as there are shuffle partitions."""
    import contextlib
    import io
    rows = spark.range(0, 40_000, 1, 1).select(F.col("id").alias("k"), (F.col("id") % 9).alias("v"))
    report = run_checks([Check("t", "k", "unique"), Check("t", "v", "accepted_range", max_value=7)], {"t": rows})
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        report.explain()
    tree = buf.getvalue().splitlines()
    counted = max(i for i, line in enumerate(tree) if "HashAggregate" in line)
    assert any("REPARTITION_BY_NUM" in line for line in tree[counted + 1:])
    got = {r.check_name: r.failures for r in report.collect()}
    assert got == {"unique": 0, "accepted_range": 40_000 // 9}
