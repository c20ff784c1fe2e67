"""Declared source columns against stored ones, the strict seed, and views
that follow their sources."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from litreflow.plans import mart_queries, view_sql
from litreflow.plans.benchmark_sources import BenchmarkSources
from litreflow.sources.contract import SourceContractError, check_contract, differences
from litreflow.sources.registry import SourceRegistry, read_seed
from litreflow.sources.schemas import SCHEMAS, schema

KEY = ("tfn_data", "vehicle")


def _written(spark, tmp_path, change=lambda df: df):
    """A root folder with one declared table, changed."""
    df = change(spark.createDataFrame([], SCHEMAS[KEY]))
    df.write.parquet(f"{tmp_path}/{KEY[0]}/{KEY[1]}")
    return SourceRegistry(spark, str(tmp_path))


def test_differences_name_the_column():
    declared = schema("A s, B d, C l")
    assert differences(declared, schema("C l, A s, B d, D s")) == []          # order and further columns are free
    assert differences(declared, schema("A s, B d, C i")) == []               # an int is read as a long
    assert differences(declared, schema("A s, B s, C l")) == ["column B is string, declared double"]
    assert differences(declared, schema("a s, C l")) == [
        "column A is missing (there is a)", "column B is missing"]


def test_a_renamed_column_stops_the_run(spark, tmp_path):
    name = SCHEMAS[KEY].fields[0].name
    src = _written(spark, tmp_path, lambda df: df.withColumnRenamed(name, "Renamed"))
    with pytest.raises(SourceContractError, match=f"tfn_data.vehicle: column {name} is missing"):
        check_contract(src)
    from litreflow.plans.job import run_tagged
    with pytest.raises(SourceContractError, match=name):
        run_tagged(spark, src, str(tmp_path / "marts"), contract=True)


def test_a_contract_that_holds(spark, tmp_path):
    src = _written(spark, tmp_path)
    assert check_contract(src) == 1                       # tables that are not there are not compared
    with pytest.raises(SourceContractError, match="tfn_data.supply_site: there is no such table"):
        check_contract(src, [KEY, ("tfn_data", "supply_site")])
    assert check_contract(BenchmarkSources(spark, SF_SMALL), [KEY]) == 1


def _seed(*lines):
    path = tempfile.mkdtemp(prefix="litreflow-seed-") + "/seed.csv"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_a_malformed_seed_row_is_an_error_that_shows_it(spark):
    header = "SupplierOrder,monday_item_id,monday_name,SentToMonday,created_at,updated_at"
    good = "SO1,m1,name,true,2025-01-01T00:00:00,2025-01-02T00:00:00"
    rows = read_seed(spark, _seed(header, good)).collect()
    assert [(r.SupplierOrder, r.SentToMonday) for r in rows] == [("SO1", True)]
    with pytest.raises(Exception, match="SO2.*maybe|MALFORMED"):
        read_seed(spark, _seed(header, good, "SO2,m2,name,maybe,2025-01-01T00:00:00,never")).collect()
    with pytest.raises(Exception, match="(?s)header.*order_no|order_no"):
        read_seed(spark, _seed(header.replace("SupplierOrder", "order_no"), good)).collect()


@pytest.mark.parametrize("query", ["mart_m04_view", "mart_m10_view"])
def test_views_follow_their_sources(spark, query):
    mart, same = view_sql.QUERIES[query]
    got = view_sql.queries()[query](spark, SF_SMALL)
    want = mart_queries.queries()[same](spark, SF_SMALL)
    assert got.columns == want.columns and got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and want.count() > 0


def test_another_session_reads_the_view_after_a_source_row_changed(spark):
    for dataset, table in view_sql.sources_of("tfn_live_vehicles"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {dataset}_v")
        (mart_queries.Marts(spark, SF_SMALL).source(dataset, table).write.mode("overwrite")
         .saveAsTable(f"{dataset}_v.{table}"))
    view, = view_sql.create_views(spark, ["tfn_live_vehicles"], lambda d: f"{d}_v")
    before = spark.table(view).count()
    gone = spark.table("tfn_data_v.vehicle").filter(F.col("VehicleID").isNotNull()).select("VehicleID").first()[0]
    left = spark.table("tfn_data_v.vehicle").filter(F.col("VehicleID") != gone).collect()
    spark.createDataFrame(left, spark.table("tfn_data_v.vehicle").schema).write.mode("overwrite").insertInto(
        "tfn_data_v.vehicle")
    other = spark.newSession()
    now = other.table(view)
    assert now.filter(F.col("VehicleID") == gone).count() == 0 and 0 < now.count() < before


def test_every_view_names_declared_sources():
    for mart in view_sql.VIEWS:
        for dataset, table in view_sql.sources_of(mart):
            assert (dataset, table) in SCHEMAS or table == "precalculated_transaction_data_partitioned"


def test_the_fact_behind_a_view_is_built_once(spark):
    """Both halves of the enriched fact come from one written build."""
    import glob

    from litreflow.plans import view_sql
    from litreflow.session import shared_dir
    pattern = f"{shared_dir(spark)}/litreflow-marts/views/*/built/precalculated_transaction_data_partitioned"
    before = set(glob.glob(pattern))
    rows = view_sql.queries()["mart_m14_view"](spark, "/root/testdata/sf0.001").count()
    built, = set(glob.glob(pattern)) - before
    assert spark.read.parquet(built).count() >= rows > 0


def test_load_view_deals_rows_out_before_the_vehicles(spark):
    """The view has the mart's rows, and its fan-out runs in all tasks."""
    got = view_sql.queries()["mart_m09_view"](spark, SF_SMALL)
    want = mart_queries.queries()["mart_m09_loads"](spark, SF_SMALL)
    assert got.columns == want.columns and got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and want.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(plan) if "REPARTITION_BY_NUM" in line]
    assert len(dealt) == 1 and sum("Join" in line for line in plan[:dealt[0]]) == 1
