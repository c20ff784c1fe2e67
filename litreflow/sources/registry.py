"""Raw tables by logical name, ``source(dataset, table)``.

A registry resolves a logical name to a DataFrame in this order:

1. a DataFrame registered with :meth:`SourceRegistry.put` (test fixtures, or
   the output of another mart that is read back as a source);
2. a Parquet dataset under ``root`` (``{root}/{dataset}/{table}``), read with
   the explicit schema from :mod:`litreflow.sources.schemas`;
3. a catalog table ``{dataset}.{table}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from litreflow.session import folder_exists
from litreflow.sources.schemas import SCHEMAS, SEED_SUPPLIER_ORDER_MONDAY


class SourceRegistry:
    def __init__(self, spark: SparkSession, root: str | None = None,
                 fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.fmt = fmt
        self._frames: dict[tuple[str, str], DataFrame] = {}

    def put(self, dataset: str, table: str, df: DataFrame) -> "SourceRegistry":
        self._frames[(dataset, table)] = df
        return self

    def has(self, dataset: str, table: str) -> bool:
        """Whether ``source`` finds the table, in the same order."""
        if (dataset, table) in self._frames:
            return True
        if self.root is not None:
            return folder_exists(self.spark, f"{self.root}/{dataset}/{table}")
        return self.spark.catalog.tableExists(f"{dataset}.{table}")

    def source(self, dataset: str, table: str) -> DataFrame:
        key = (dataset, table)
        if key in self._frames:
            return self._frames[key]
        if self.root is not None:
            reader = self.spark.read.format(self.fmt)
            if key in SCHEMAS:
                reader = reader.schema(SCHEMAS[key])
            return reader.load(f"{self.root}/{dataset}/{table}")
        return self.spark.table(f"{dataset}.{table}")

    def stored_schema(self, dataset: str, table: str) -> StructType | None:
        """The columns that are there, from the files' footers or the catalog;
        None if the table is not."""
        if not self.has(dataset, table):
            return None
        if (dataset, table) not in self._frames and self.root is not None:
            return self.spark.read.format(self.fmt).load(f"{self.root}/{dataset}/{table}").schema
        return self.source(dataset, table).schema

    def fixture(self, dataset: str, table: str, rows: list) -> DataFrame:
        """Register in-memory rows with the table's declared schema."""
        df = self.spark.createDataFrame(rows, SCHEMAS[(dataset, table)])
        self.put(dataset, table, df)
        return df


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The supplier-order mapping seed (CSV with a header line). A header with
    other names, or a row that does not fit, is an error that shows it."""
    return (spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
            .schema(SEED_SUPPLIER_ORDER_MONDAY).csv(path))
