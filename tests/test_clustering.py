"""Space-filling order: what a read by any one key touches."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_CHECK
from litreflow.sinks.clustering import interleaved, write_clustered

KEYS = ["l_partkey", "l_suppkey", "customer"]


def _touched(path, key, value):
    """Row groups whose min and max admit the value, and all of them."""
    hit = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().get_field_index(key)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    return hit, total


def test_bits_are_interleaved(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    got = {(r.a, r.b): r.z for r in df.withColumn("z", interleaved([F.col("a"), F.col("b")], 2)).collect()}
    want = {(a, b): (a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | (b & 1) for a in range(4) for b in range(4)}
    assert got == want


def test_a_read_by_any_one_key_touches_few_row_groups(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_CHECK}/orders.parquet").select("o_orderkey", F.concat(
        F.lit("C"), F.lpad(F.col("o_custkey").cast("string"), 6, "0")).alias("customer"))
    rows = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*KEYS, "l_quantity")
    rows = rows.withColumn("customer", F.when(F.col("l_quantity") != 7, F.col("customer")))  # some have none
    path = f"{tmp_path}/clustered"
    write_clustered(rows, path, KEYS, files=64, bits=4, row_group_rows=100)
    back = spark.read.parquet(path)
    assert back.columns == rows.columns and back.count() == rows.count()
    assert back.exceptAll(rows).count() == 0
    for key in KEYS:
        values = [r[0] for r in rows.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(
            F.xxhash64(key)).limit(30).collect()]
        shares = []
        for v in values:
            hit, total = _touched(path, key, v)
            assert total > 300
            shares.append(hit / total)
        assert sum(shares) / len(shares) < 0.25, (key, shares)
        # the filter is what a reader sees
        assert back.filter(F.col(key) == values[0]).count() == rows.filter(F.col(key) == values[0]).count()
