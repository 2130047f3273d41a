"""Incremental data-pipeline operators for multi-source entity data, written for Spark DataFrames."""

from millrace.session import tune

__all__ = ["tune"]
