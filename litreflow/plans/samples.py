"""The two starter models: inline rows with a NULL id, and a filter on
them. They serve as the negative case of the not_null/unique checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def my_first_model(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1,), (None,)], "id int")


def my_second_model(first: DataFrame) -> DataFrame:
    return first.filter(F.col("id") == 1)
