"""Fixed time windows over arriving rows: slice, replay of all ticks, late rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.times import time_literal, to_micros


def window_slice(df: DataFrame, ts_col: str, start: datetime | None, end: datetime | None) -> DataFrame:
    """Rows with ``start < ts <= end``; a missing bound is open."""
    ts, kind = F.col(ts_col), df.schema[ts_col].dataType
    if start is not None:
        df = df.filter(ts > time_literal(start, kind))
    if end is not None:
        df = df.filter(ts <= time_literal(end, kind))
    return df


def first_tick(df: DataFrame, ts_col: str) -> DataFrame:
    """One row: what an unbounded first tick takes in, and the watermark it leaves."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.max(ts_col).alias("watermark"))


def _micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def replay_windows(df: DataFrame, ts_col: str, start: datetime, width: timedelta) -> DataFrame:
    """All consecutive ticks ``(start + k*width, start + (k+1)*width]`` up to the last row, empty ones included.

    (tick, window_start, window_end, n_rows); ``window_end`` is the watermark after the tick. The tick of a row is
    computed from its timestamp, so this is one aggregation and an equi-join rather than a range join. The last tick is
    read first, so that the empty ones are made in parallel.
    """
    span = width // timedelta(microseconds=1)
    origin = F.lit(to_micros(start))
    ticks = (
        df.filter(F.col(ts_col) > time_literal(start, df.schema[ts_col].dataType))
        .groupBy(F.floor((_micros(F.col(ts_col)) - origin - 1) / F.lit(span)).alias("tick"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_empty_ticks(ticks, start, width)


def with_empty_ticks(ticks: DataFrame, start: datetime, width: timedelta) -> DataFrame:
    """(tick, window_start, window_end, n_rows) of counted ticks ``(tick, n)`` and of the empty ones between them."""
    span = width // timedelta(microseconds=1)
    origin = F.lit(to_micros(start))
    last = ticks.agg(F.max("tick")).first()[0]
    every = ticks.sparkSession.range(0 if last is None else last + 1).withColumnRenamed("id", "tick")

    def edge(offset: int) -> Column:
        return F.timestamp_micros(origin + (F.col("tick") + offset) * span).cast("timestamp_ntz")

    return every.join(ticks, "tick", "left").select(
        "tick",
        edge(0).alias("window_start"),
        edge(1).alias("window_end"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"),
    )


def late_rows(df: DataFrame, ts_col: str, watermark: datetime) -> DataFrame:
    """Rows that a tick at ``watermark`` will never read: their time has passed, or cannot be told."""
    passed = F.col(ts_col) <= time_literal(watermark, df.schema[ts_col].dataType)
    return df.filter(passed | F.col(ts_col).isNull())


def late_report(df: DataFrame, ts_col: str, watermark: datetime, by: list[str]) -> DataFrame:
    """(by..., n_late, n_ahead) relative to the watermark."""
    late = F.coalesce(F.col(ts_col) <= time_literal(watermark, df.schema[ts_col].dataType), F.lit(True))
    return df.groupBy(*by).agg(F.count_if(late).alias("n_late"), F.count_if(~late).alias("n_ahead"))
