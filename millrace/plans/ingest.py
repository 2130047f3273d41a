"""Landing to bronze: fixed-window ticks with a watermark per source."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import with_audit, with_partitions
from millrace.functions.times import from_micros, processing_time, time_literal
from millrace.operators.keyed import dedup_latest
from millrace.operators.windows import window_slice
from millrace.plans.store import Store
from millrace.session import written
from millrace.functions.joins import any_null, anti_join
from millrace.sources.landing import REASON, LandingMissing, SourceSpec, landing_is_empty, read_landing, readable, unreadable
from millrace.sources.tables import ParquetTable, TableMissing

INGESTED, EMPTY_WINDOW, EMPTY_LANDING, NO_LANDING = "INGESTED", "EMPTY_WINDOW", "EMPTY_LANDING", "NO_LANDING"


@dataclass(frozen=True)
class IngestResult:
    """What one tick did; ``skipped`` tells the caller that nothing downstream can have changed."""

    source: str
    status: str
    rows: int
    start: datetime | None
    end: datetime | None
    watermark: datetime | None
    rejected: int = 0

    @property
    def skipped(self) -> bool:
        return self.status != INGESTED


def read_watermark(store: Store, source: str) -> datetime | None:
    """The end of the last window of a source (UTC, without zone), or None before its first tick."""
    try:
        table = store.control(f"watermark_{source}").read()
    except TableMissing:
        return None
    # Through epoch micros: a timestamp would reach the driver in the zone of its own clock.
    row = table.select(F.unix_micros("last_processed").alias("us")).first()
    return None if row is None or row["us"] is None else from_micros(row["us"])


def write_watermark(store: Store, source: str, value: datetime, now: datetime | None = None) -> None:
    """Replace the watermark row of a source."""
    row = store.spark.range(1).select(
        F.lit(source).alias("source"),
        time_literal(value).alias("last_processed"),
        processing_time(now).alias("updated_at"),
    )
    store.control(f"watermark_{source}").overwrite(row.coalesce(1))


def window_rows(landing: DataFrame, spec: SourceSpec, start: datetime | None, end: datetime | None) -> DataFrame:
    """Readable rows of one window, and every unreadable row; bounds are UTC."""
    bad = landing.filter(F.col(REASON).isNotNull())
    return window_slice(landing.filter(F.col(REASON).isNull()), spec.ts_col, start, end).unionByName(bad)


def bronze_slice(rows: DataFrame, spec: SourceSpec, now: datetime | None = None) -> DataFrame:
    """Readable rows with audit and partition columns."""
    return with_partitions(with_audit(readable(rows), spec.ts_col, now), spec.ts_col)


def reject(table: ParquetTable, rows: DataFrame, spec: SourceSpec, now: datetime | None = None) -> int:
    """Append the unreadable rows of files that have not been seen here before; returns their number.

    Landing files never change, so each such row is kept once, whatever number of ticks reads its file.
    """
    bad = unreadable(rows, spec, processing_time(now))
    if table.exists():
        bad = anti_join(bad, table.read(), ["source_file"])
    with written(bad, f"{spec.name}-rejected") as new:
        n = new.count()
        if n:
            table.append(new)
    return n


def without_known(rows: DataFrame, bronze: DataFrame, spec: SourceSpec) -> DataFrame:
    """``rows`` without those that have a NULL key and are in the table already, from the same file.

    A NULL key matches nothing, so a tick that is repeated after a failure would add such rows once more.
    """
    same = F.struct(*[F.col(f"`{c}`") for c in (*spec.types, "source_file")])
    known = bronze.filter(any_null(spec.keys)).select(same.alias("_same")).distinct()
    return rows.withColumn("_same", F.when(any_null(spec.keys), same)).join(known, "_same", "left_anti").drop("_same")


def ingest_tick(
    store: Store,
    spec: SourceSpec,
    landing_path: str,
    start: datetime | None = None,
    windows: int = 1,
    now: datetime | None = None,
) -> IngestResult:
    """Take the next window of a feed into its bronze table and advance the watermark.

    The window is ``(watermark, watermark + width]`` and the watermark moves to its end even when it was empty. Without
    a watermark the tick starts at ``start``, or takes everything and leaves the greatest timestamp as watermark.
    ``windows`` ticks can be taken in one scan of the landing zone: later rows win, so the table is the same.
    A missing or empty landing zone changes nothing. A feed that lands by day is scanned in the folders of the window.

    The watermark is written last: a tick that ended before is taken again, with the same result.

    Unreadable rows have no place in time: the first tick that reads their file sends them to the rejected rows of the
    source, which are part of its quarantine.
    """
    spark = store.spark
    watermark = read_watermark(store, spec.name)
    lower = watermark if watermark is not None else start
    upper = None if lower is None else lower + spec.window * windows
    try:
        landing = read_landing(spark, spec, landing_path, lower, upper)
    except LandingMissing:
        return IngestResult(spec.name, NO_LANDING, 0, lower, upper, watermark)

    with written(window_rows(landing, spec, lower, upper), spec.name) as rows:
        is_bad = F.col(REASON).isNotNull()
        seen = rows.agg(
            F.count_if(~is_bad).alias("n"), F.count_if(is_bad).alias("bad"), F.count_if(~is_bad & any_null(spec.keys)).alias("keyless"),
            F.max(F.when(~is_bad, F.unix_micros(spec.ts_col))).alias("us"),
        ).first()
        # Only a tick without rows needs to know whether there is a landing zone at all.
        if seen["n"] + seen["bad"] == 0 and landing_is_empty(spark, spec, landing_path):
            return IngestResult(spec.name, EMPTY_LANDING, 0, lower, upper, watermark)
        reached = upper if upper is not None else (from_micros(seen["us"]) if seen["us"] is not None else None)
        rejected = reject(store.rejected(spec.name), rows, spec, now) if seen["bad"] else 0
        if seen["n"] > 0:
            bronze = store.bronze(spec.name)
            latest = dedup_latest(bronze_slice(rows, spec, now), spec.keys, spec.ts_col)
            if seen["keyless"] and bronze.exists():
                latest = without_known(latest, bronze.read(), spec)
            bronze.merge(latest, spec.keys)
    if reached is not None:
        write_watermark(store, spec.name, reached, now)
    status = INGESTED if seen["n"] or rejected else EMPTY_WINDOW
    return IngestResult(spec.name, status, seen["n"], lower, upper, reached, rejected)


def ingest_all(
    store: Store, feeds: Iterable[tuple[SourceSpec, str]], now: datetime | None = None
) -> list[IngestResult]:
    """One tick for each (feed, landing path)."""
    return [ingest_tick(store, spec, path, now=now) for spec, path in feeds]
