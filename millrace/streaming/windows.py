"""Windows and late rows of a stream, by event time."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.times import to_micros
from millrace.session import written
from millrace.sources.tables import ParquetTable

BY_BATCH = {"batch": "long"}
BY_DAY = {"day": "date"}
MICROSECOND = timedelta(microseconds=1)


def stream_windows(
    rows: DataFrame, ts_col: str, start: datetime, width: timedelta, lateness: str, table: ParquetTable, checkpoint: str
) -> StreamingQuery:
    """Rows per window ``(start + k * width, start + (k + 1) * width]`` of a stream, kept in ``table`` (tick, n, day).

    Windows of Spark are closed on the left, so times are moved back by a microsecond. State is kept until the watermark,
    ``lateness`` behind the greatest time, has passed a window; rows later than that are dropped. A batch writes the
    windows that it changed, with their whole count, so a repeated batch changes nothing. ``table`` is partitioned by
    ``BY_DAY``.
    """
    span, origin = width // MICROSECOND, to_micros(start)
    moved = F.timestamp_micros(F.unix_micros(F.col(ts_col).cast("timestamp")) - 1)
    times = rows.select(moved.alias("at")).filter(F.unix_micros("at") >= origin).withWatermark("at", lateness)
    window = F.window("at", f"{span} microseconds", startTime=f"{origin % span} microseconds")
    counts = times.groupBy(window.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    tick = F.floor((F.unix_micros("w.start") - origin) / span).alias("tick")

    def keep(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            table.merge(batch.select(tick, "n", F.to_date("w.start").alias("day")), ["tick"])

    writer = counts.writeStream.outputMode("update").foreachBatch(keep)
    return writer.trigger(availableNow=True).option("checkpointLocation", checkpoint).start()


def stream_by_lateness(
    rows: DataFrame, ts_col: str, lateness: timedelta, on_time: ParquetTable, late: ParquetTable, marks: ParquetTable, checkpoint: str
) -> StreamingQuery:
    """Split a stream into rows that are on time and rows at or before the watermark when they come; none is dropped.

    The watermark of a batch is ``lateness`` behind the greatest time of all batches before it. Those times are kept in
    ``marks``, one row per batch, so they survive a restart and a batch that is repeated is split as it was. Rows without
    a time are late. All three tables are partitioned by ``BY_BATCH``, and each batch replaces its own partition.
    """
    micros = F.unix_micros(F.col(ts_col).cast("timestamp"))

    def split(batch: DataFrame, number: int) -> None:
        with written(batch, "batch") as read:
            if read.isEmpty():
                return
            numbered = read.withColumn("batch", F.lit(number).cast("long"))
            before = marks.read().filter(F.col("batch") < number).agg(F.max("micros")).first()[0] if marks.exists() else None
            passed = F.lit(False) if before is None else micros <= before - lateness // MICROSECOND
            is_late = F.coalesce(passed, F.lit(True)) | micros.isNull()
            on_time.overwrite_partitions(numbered.filter(~is_late))
            late.overwrite_partitions(numbered.filter(is_late))
            marks.overwrite_partitions(numbered.groupBy("batch").agg(F.max(micros).alias("micros")).select("micros", "batch"))

    return rows.writeStream.foreachBatch(split).trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
