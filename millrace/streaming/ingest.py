"""Landing to bronze as a stream: the file source remembers what it has read, a batch sink merges by key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.columns import with_audit, with_partitions
from millrace.operators.keyed import dedup_latest
from millrace.session import written
from millrace.plans.ingest import reject
from millrace.sources.landing import READ_OPTIONS, SourceSpec, bind_source, readable
from millrace.sources.tables import ParquetTable


def landing_stream(spark, spec: SourceSpec, path: str, max_files: int | None = None) -> DataFrame:
    """New rows of a landing directory, unreadable ones among them. A CSV file with another header is an error."""
    reader = (
        spark.readStream.format(spec.format)
        .schema(spec.raw_schema)
        .option("recursiveFileLookup", "true")
        .options(**READ_OPTIONS[spec.format], enforceSchema="false")
        .options(**spec.options)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return bind_source(reader.load(path), spec)


def stream_ingest(
    table: ParquetTable,
    spec: SourceSpec,
    landing_path: str,
    checkpoint: str,
    lateness: str | None = None,
    max_files: int | None = None,
    now: datetime | None = None,
    rejected: ParquetTable | None = None,
) -> StreamingQuery:
    """Merge every file that has landed since the last run into a bronze table, then stop.

    Each landing file is read once, whatever the size of the landing zone. Of a key's rows the latest by the watermark
    column stays, in whatever order the files come. A batch that is retried after a failure is
    merged again by key, with the same result. With ``lateness`` a key seen before within that time is suppressed
    instead of merged, and rows later than that are dropped. Unreadable rows are appended to ``rejected``, once for each
    file; without such a table they are left out.
    """
    rows = landing_stream(table.spark, spec, landing_path, max_files)
    if lateness is not None:
        rows = rows.withWatermark(spec.ts_col, lateness).dropDuplicatesWithinWatermark(list(spec.keys))

    def merge(batch: DataFrame, _: int) -> None:
        with written(batch, f"{spec.name}-batch") as read:
            if rejected is not None:
                reject(rejected, read, spec, now)
            slice_ = with_partitions(with_audit(readable(read), spec.ts_col, now), spec.ts_col)
            if slice_.isEmpty():
                return
            # A later file may hold an earlier row: what the table knows of these keys takes part in the choice.
            latest = dedup_latest(slice_, spec.keys, spec.ts_col)
            table.merge(latest, spec.keys, latest=spec.ts_col, dedup=dedup_latest)

    return (
        rows.writeStream.foreachBatch(merge)
        .trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .start()
    )
