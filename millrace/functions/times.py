"""UTC times without zone on the driver, as Spark literals and back."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType


def to_micros(value: datetime) -> int:
    """Microseconds since the epoch; a time without zone is UTC."""
    whole = value if value.tzinfo else value.replace(tzinfo=timezone.utc)
    return int(whole.replace(microsecond=0).timestamp()) * 1_000_000 + value.microsecond


def from_micros(micros: int) -> datetime:
    """UTC time without zone."""
    seconds, rest = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(seconds, timezone.utc).replace(tzinfo=None, microsecond=rest)


def time_literal(value: datetime, kind: DataType | None = None) -> Column:
    """A timestamp literal of the type of the column it is compared with, so that the column itself is never cast."""
    if isinstance(kind, TimestampNTZType):
        return F.lit(from_micros(to_micros(value)).isoformat(sep=" ")).cast("timestamp_ntz")
    return F.timestamp_micros(F.lit(to_micros(value)))


def processing_time(now: datetime | None = None) -> Column:
    """The current time, or a fixed one for reproducible runs."""
    return F.current_timestamp() if now is None else time_literal(now)
