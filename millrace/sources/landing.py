"""Landing feeds: directories of immutable CSV or JSON-lines files.

Nothing that lands is lost in reading. A line that is no record, a row whose time cannot be told and a row in the folder
of another day are kept as text, with a reason, beside the readable rows. Files of one feed may differ in their columns: each is
read by its own header (or by its own names, for JSON), columns that it lacks are NULL, and columns that the feed does
not declare are left out or, on request, handed over.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Columns that a scan adds: the text of the watermark, a line that is no record, why a row is unreadable.
TIME_TEXT, CORRUPT, REASON = "watermark_text", "corrupt_record", "unreadable"
NO_RECORD, NO_TIME, OTHER_DAY = "unreadable_record", "unreadable_time", "time_of_another_day"


class LandingMissing(Exception):
    """The landing directory does not exist."""


@dataclass(frozen=True)
class SourceSpec:
    """One feed: its columns with their silver types, its key and the column that orders arrivals.

    ``day_folder`` names the folders of a feed that lands by day (``<name>=2024-01-31``); a scan of some time then lists
    and reads only the folders of its days.
    """

    name: str
    format: str
    types: dict[str, str]
    keys: tuple[str, ...]
    ts_col: str
    window: timedelta = timedelta(minutes=60)
    options: dict[str, str] = field(default_factory=dict)
    day_folder: str | None = None

    @property
    def raw_schema(self) -> StructType:
        """Landing schema: every column as text, so that no malformed value is lost before quarantine."""
        return text_schema(list(self.types))

    @property
    def silver_schema(self) -> StructType:
        """Typed columns of the feed."""
        return StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in self.types.items()))


# Reader options per format; the schema is given, so no inference pass reads the files first.
READ_OPTIONS = {
    "csv": {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    "json": {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
}


def text_schema(names: Sequence[str]) -> StructType:
    """Columns of text, and the one for lines that are no record."""
    return StructType([StructField(name, StringType()) for name in [*names, CORRUPT]])


def bind_source(df: DataFrame, spec: SourceSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Type the watermark column, attach the file name and the reason of unreadable rows; batch and stream share it.

    Columns of the feed that ``df`` lacks are NULL.
    """
    missing = F.lit(None).cast("string")
    text = {name: F.col(f"`{name}`") if name in df.columns else missing for name in spec.types}
    time = text[spec.ts_col].try_cast("timestamp")
    path = F.col("_metadata.file_path")
    reason = F.when(F.col(CORRUPT).isNotNull(), NO_RECORD).when(time.isNull(), NO_TIME)
    if spec.day_folder is not None:
        folder = F.regexp_extract(path, f"/{re.escape(spec.day_folder)}=([0-9-]+)/", 1).try_cast("date")
        reason = reason.when(folder != F.to_date(time), OTHER_DAY)
    columns = [(time if name == spec.ts_col else column).alias(name) for name, column in text.items()]
    added = [text[spec.ts_col].alias(TIME_TEXT), F.col(CORRUPT), reason.alias(REASON), path.alias("source_file")]
    return df.select(*columns, *[F.col(f"`{name}`") for name in extra], *added)


def folders(spec: SourceSpec, path: str, start: datetime | None, end: datetime | None) -> str:
    """Where the rows of a time lie: the folders of its days as one pattern, or the whole landing zone."""
    if spec.day_folder is None or start is None or end is None:
        return path
    first, last = start.date(), end.date()
    days = [first + timedelta(days=k) for k in range((last - first).days + 1)]
    return f"{path.rstrip('/')}/{spec.day_folder}={{{','.join(map(date.isoformat, days))}}}"


def _reader(spark: SparkSession, spec: SourceSpec, schema: StructType):
    options = {**READ_OPTIONS[spec.format], **spec.options}
    return spark.read.format(spec.format).schema(schema).option("recursiveFileLookup", "true").options(**options)


def _headers(spark: SparkSession, path: str) -> list[tuple[str, list[str]]]:
    """The distinct first lines of the files below a path, with the files that begin so."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    firsts = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    firsts = firsts.filter("at = 0").withColumn("line", F.monotonically_increasing_id())
    by_file = firsts.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    found = by_file.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    return sorted((row["header"], row["files"]) for row in found)


def _by_header(spark: SparkSession, spec: SourceSpec, path: str, others: bool) -> DataFrame:
    """A CSV feed, each group of files with the columns of its own header."""
    groups = _headers(spark, path)
    header = {"header": "true", **spec.options}
    names = [spark.read.options(**header).csv(files[0]).columns for _, files in groups]
    declared = list(spec.types)
    extra = sorted({n for own in names for n in own} - set(declared)) if others else []

    def read(own: list[str], files: list[str] | str) -> DataFrame:
        rows = _reader(spark, spec, text_schema(own)).load(files)
        more = {n: F.lit(None).cast("string") for n in extra if n not in own}
        return bind_source(rows.select("*", "_metadata").withColumns(more) if more else rows, spec, extra)

    if len(groups) <= 1:
        return read(names[0] if names else declared, path)
    return reduce(DataFrame.unionByName, [read(own, files) for own, (_, files) in zip(names, groups)])


def read_landing(
    spark: SparkSession,
    spec: SourceSpec,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    others: bool = False,
) -> DataFrame:
    """Scan a landing directory recursively; columns stay text except the watermark column.

    Adds ``watermark_text``, ``corrupt_record``, ``unreadable`` (NULL for a readable row) and ``source_file``. ``start``
    and ``end`` choose folders, not rows. ``others`` hands over the columns of a CSV feed that it does not declare.
    """
    place = folders(spec, path, start, end)
    try:
        if spec.format == "csv":
            return _by_header(spark, spec, place, others)
        return bind_source(_reader(spark, spec, spec.raw_schema).load(place), spec)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if place == path:
            raise LandingMissing(path) from error
    # No folder of these days: the landing zone may be there all the same.
    return bind_source(_whole(spark, spec, path), spec).limit(0)


def _whole(spark: SparkSession, spec: SourceSpec, path: str) -> DataFrame:
    try:
        return _reader(spark, spec, spec.raw_schema).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise LandingMissing(path) from error
        raise


def landing_is_empty(spark: SparkSession, spec: SourceSpec, path: str) -> bool:
    """Whether a landing zone holds no row at all."""
    return _whole(spark, spec, path).isEmpty()


def readable(landing: DataFrame) -> DataFrame:
    """The rows of a scan that can be read, without the columns about those that cannot."""
    return landing.filter(F.col(REASON).isNull()).drop(TIME_TEXT, CORRUPT, REASON)


def unreadable(landing: DataFrame, spec: SourceSpec, loaded: Column) -> DataFrame:
    """The rows of a scan that cannot be read, all as text, with their reason and load time."""
    texts = [F.col(TIME_TEXT).alias(name) if name == spec.ts_col else F.col(f"`{name}`") for name in spec.types]
    rows = landing.filter(F.col(REASON).isNotNull())
    return rows.select(*texts, TIME_TEXT, CORRUPT, REASON, "source_file", loaded.alias("ingestion_timestamp"))
