"""Where the tables of one deployment live."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from millrace.sources.tables import ParquetTable

BY_MONTH = {"year": "int", "month": "int"}


@dataclass(frozen=True)
class Store:
    """Tables below one root, by layer and name."""

    spark: SparkSession
    root: str

    def bronze(self, source: str) -> ParquetTable:
        return ParquetTable(self.spark, f"{self.root}/bronze/{source}", BY_MONTH)

    def rejected(self, source: str) -> ParquetTable:
        """Rows that could not be read, as text."""
        return ParquetTable(self.spark, f"{self.root}/bronze/{source}_rejected")

    def silver(self, source: str) -> ParquetTable:
        """Valid and quarantined rows side by side, told apart by the partition column ``is_valid``."""
        return ParquetTable(self.spark, f"{self.root}/silver/{source}", {"is_valid": "boolean", **BY_MONTH})

    def gold(self, name: str) -> ParquetTable:
        return ParquetTable(self.spark, f"{self.root}/gold/{name}")

    def control(self, name: str) -> ParquetTable:
        return ParquetTable(self.spark, f"{self.root}/control/{name}")

    def model_path(self, version: int) -> str:
        return f"{self.root}/models/version={version}"
