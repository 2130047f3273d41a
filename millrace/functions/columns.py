"""Projections: typed casts, audit and partition columns, column selection by exclusion."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from millrace.functions.times import processing_time


# Anything but digits, signs, blanks and control characters: no integer can contain it.
NOT_IN_INTEGERS = r"[^0-9+\-\s\p{Cntrl}]"
# What common tools write for an integer in a column with missing values.
WHOLE_DECIMAL = r"^\s*[+-]?[0-9]+\.0*\s*$"
INTEGERS = ("tinyint", "smallint", "int", "bigint")


def safe_cast(column: Column, source: DataType, target: str) -> Column:
    """Cast that turns a malformed value into NULL.

    A failing text-to-integer cast costs an exception per row, a hundred times the cast itself, so obvious misfits are
    turned away by a pattern first. A decimal without a fraction, like ``72.0``, is the integer it says.
    """
    kind = StructType.fromDDL(f"c {target}")["c"].dataType.simpleString()
    if isinstance(source, StringType) and kind in INTEGERS:
        whole = F.when(column.rlike(WHOLE_DECIMAL), F.substring_index(column, ".", 1))
        return F.when(~column.rlike(NOT_IN_INTEGERS), column).otherwise(whole).try_cast(target)
    return column.try_cast(target)


def cast_columns(df: DataFrame, types: Mapping[str, str], on_error: str = "null") -> DataFrame:
    """Cast the listed columns in one projection; a malformed value becomes NULL, or raises on request."""
    if on_error not in ("null", "raise"):
        raise ValueError(f"on_error must be 'null' or 'raise', not {on_error!r}")

    def typed(field: StructField) -> Column:
        column = F.col(field.name)
        if field.name not in types:
            return column
        target = types[field.name]
        typed = safe_cast(column, field.dataType, target) if on_error == "null" else column.cast(target)
        return typed.alias(field.name)

    return df.select(*[typed(field) for field in df.schema.fields])


def with_arrival(df: DataFrame, ts_col: str, name: str = "arrival_date") -> DataFrame:
    """Add the arrival date, taken from the watermark column of the row itself."""
    return df.withColumn(name, F.to_date(ts_col))


def with_audit(
    df: DataFrame, ts_col: str, now: datetime | None = None, arrival: str = "sim_arrival_date"
) -> DataFrame:
    """Add load time and arrival date; the file name is already bound by the landing scan."""
    return df.withColumns({"ingestion_timestamp": processing_time(now), arrival: F.to_date(ts_col)})


def with_partitions(df: DataFrame, ts_col: str) -> DataFrame:
    """Add ``year`` and ``month`` of the watermark column."""
    return df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})


def business_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """Columns of ``df`` outside the exclusion set, in table order."""
    hidden = set(exclude)
    return [name for name in df.columns if name not in hidden]


def feature_columns(df: DataFrame, exclude: Iterable[str], forbidden: Iterable[str] = ()) -> list[str]:
    """Model inputs of ``df``; raises when a column that would leak the outcome is among them."""
    features = business_columns(df, exclude)
    leaked = sorted(set(features) & set(forbidden))
    if leaked:
        raise ValueError(f"columns must not be model inputs: {leaked}")
    return features
