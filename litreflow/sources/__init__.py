"""Inputs: the registry of raw tables by logical name, their schemas, the CSV
seed, and the driver's benchmark tables."""

from litreflow.sources.registry import SourceRegistry
from litreflow.sources.tables import DriverTables

__all__ = ["SourceRegistry", "DriverTables"]
