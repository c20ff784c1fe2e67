"""The benchmark tables (one Parquet dataset per table under ``sf_dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class DriverTables:
    """Lazy, per-name access: ``t.lineitem`` is a Parquet scan of
    ``{sf_dir}/lineitem.parquet``. Nothing is read until an action runs;
    Catalyst prunes columns and pushes filters into each scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def get(self, name: str) -> DataFrame:
        if name not in DRIVER_TABLES:
            raise KeyError(f"unknown table {name!r}")
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        return self.get(name)


_SHARED: dict[tuple[int, str], DriverTables] = {}


def tables_for(spark: SparkSession, sf_dir: str) -> DriverTables:
    """One ``DriverTables`` per session and folder, so composed queries
    share their scans' metadata (each Parquet read lists files and reads a
    footer on the driver)."""
    key = (id(spark), sf_dir.rstrip("/"))
    t = _SHARED.get(key)
    if t is None or t.spark is not spark:
        t = _SHARED[key] = DriverTables(spark, sf_dir)
    return t
