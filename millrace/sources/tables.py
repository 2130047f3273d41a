"""Tables as plain parquet directories, written by Spark's own writer.

A keyed merge rewrites the partitions that hold one of its keys, and only those: their new content is written to the
scratch folder first and then replaces them by dynamic partition overwrite, so a table is never read while it is
overwritten. Rows for other partitions are added to them, unless a partition has many small files: then it is rewritten
too, so the number of small files does not grow with the number of merges. A repeated merge changes nothing, which makes
a write that was cut short repairable by repeating it. There is one writer per table and no history.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.joins import anti_join
from millrace.session import written

MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
# A partition with so many files below so many bytes is rewritten when rows come to it.
MOST_SMALL, SMALL_BYTES = 16, 16 << 20


class TableMissing(Exception):
    """There is no table at this path."""


def checked_schema(old: StructType, new: StructType) -> None:
    """Raise where a column changes its type."""
    known = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        if f.name in known and known[f.name] != f.dataType:
            raise ValueError(f"column {f.name!r} is {known[f.name]}, not {f.dataType}")


def any_of(conditions: Sequence[Column]) -> Column:
    """Disjunction as a balanced tree, so that thousands of them stay shallow."""
    if len(conditions) <= 1:
        return conditions[0] if conditions else F.lit(False)
    half = len(conditions) // 2
    return any_of(conditions[:half]) | any_of(conditions[half:])


def in_partitions(parts: Sequence[Row]) -> Column:
    """Rows of these partitions: a condition on partition columns alone, so that the scan lists no other files."""
    return any_of([reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in row.asDict().items()]) for row in parts])


class ParquetTable:
    """A parquet table, optionally partitioned by columns of given types."""

    def __init__(self, spark: SparkSession, path: str, partition_by: Mapping[str, str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = dict(partition_by or {})

    @property
    def parts(self) -> list[str]:
        return list(self.partition_by)

    # -- reading ---------------------------------------------------------------------------------------------------

    def _scan(self) -> DataFrame:
        """All rows with all columns that any file has; partition columns last, in their declared types."""
        try:
            found = self.spark.read.option("mergeSchema", "true").parquet(self.path).schema
            kinds = StructType.fromDDL(", ".join(f"`{c}` {kind}" for c, kind in self.partition_by.items())) if self.parts else StructType()
            fields = [f for f in found.fields if f.name not in self.partition_by]
            return self.spark.read.schema(StructType([*fields, *kinds.fields])).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() in MISSING:
                raise TableMissing(self.path) from error
            raise

    def read(self) -> DataFrame:
        return self._scan()

    def exists(self) -> bool:
        try:
            self._scan()
        except TableMissing:
            return False
        return True

    def read_or_empty(self, schema: StructType) -> DataFrame:
        """Scan the table, or an empty frame with the full declared schema when there is none."""
        try:
            return self.read()
        except TableMissing:
            return self.spark.createDataFrame([], schema)

    def modified(self) -> int:
        """Epoch milliseconds of the newest file; read from file metadata."""
        newest = F.max(F.unix_millis("_metadata.file_modification_time"))
        return self._scan().agg(newest.alias("at")).first()["at"] or 0

    # -- writing ---------------------------------------------------------------------------------------------------

    def _write(self, df: DataFrame, mode: str, **options: str) -> None:
        if self.parts:
            # Adaptive rebalancing gives few files per partition and splits a partition that holds most rows.
            df.hint("rebalance", *self.parts).write.mode(mode).options(**options).partitionBy(*self.parts).parquet(self.path)
        else:
            df.write.mode(mode).parquet(self.path)

    def overwrite(self, df: DataFrame) -> None:
        """Replace content and schema; ``df`` must not read this table."""
        self._write(df, "overwrite", partitionOverwriteMode="static")

    def overwrite_partitions(self, df: DataFrame) -> None:
        """Replace the partitions that ``df`` has rows of; ``df`` must not read this table."""
        self._write(df, "overwrite", partitionOverwriteMode="dynamic")

    def append(self, df: DataFrame) -> None:
        """Add rows; columns that are new read as NULL from older rows, a changed type is an error."""
        try:
            checked_schema(self._scan().schema, df.schema)
        except TableMissing:
            pass
        self._write(df, "append")

    def merge(self, source: DataFrame, keys: Sequence[str], latest: str | None = None, dedup: Callable | None = None) -> None:
        """Keyed upsert, source wins. ``source`` is unique on ``keys``; rows with a NULL key are added.

        With ``latest``, the greatest of that column wins between the source and the table, by ``dedup`` (rows, keys,
        column).
        """
        with written(source, "merge-source") as rows:
            try:
                target = self._scan()
            except TableMissing:
                self.overwrite(rows)
                return
            checked_schema(target.schema, rows.schema)
            wanted = rows.select(*keys).distinct()
            scope, touched = self._touched(target, wanted, keys)
            if latest is None or (self.parts and not touched):
                self._put(target, rows, wanted, keys, touched)
                return
            known = scope.join(wanted, list(keys), "left_semi").select(*scope.columns)
            with written(dedup(rows.unionByName(known, allowMissingColumns=True), keys, latest), "merge-latest") as winners:
                self._put(target, winners, wanted, keys, touched)

    def _put(self, target: DataFrame, rows: DataFrame, wanted: DataFrame, keys: Sequence[str], touched: Sequence[Row]) -> None:
        """Let ``rows`` take the place of the wanted keys in the touched partitions; to other partitions they are added."""
        replaced, added = list(touched), []
        if self.parts:
            fresh = [row for row in rows.select(*self.parts).distinct().collect() if row not in replaced]
            crowded = self._crowded(target, fresh)
            replaced, added = [*replaced, *crowded], [row for row in fresh if row not in crowded]
        if replaced or not self.parts:
            scope = target.filter(in_partitions(replaced)) if self.parts else target
            new = rows.filter(in_partitions(replaced)) if added else rows
            self._replace(target, anti_join(scope, wanted, keys, unique=True).unionByName(new, allowMissingColumns=True), replaced)
        if added:
            self._write(rows.filter(in_partitions(added)) if replaced else rows, "append")

    def _crowded(self, target: DataFrame, parts: Sequence[Row]) -> list[Row]:
        """Those of the partitions that lie in many small files; only small files are read."""
        if not parts:
            return []
        small = target.filter(in_partitions(parts) & (F.col("_metadata.file_size") < SMALL_BYTES))
        files = small.select(*self.parts, F.col("_metadata.file_path").alias("_file")).distinct()
        many = files.groupBy(*self.parts).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= MOST_SMALL)
        return many.select(*self.parts).collect()

    def delete(self, keys_df: DataFrame, keys: Sequence[str]) -> None:
        """Delete the rows whose key is in ``keys_df``; nothing is written where there are none."""
        wanted = keys_df.select(*keys).distinct()
        target = self._scan()
        scope, touched = self._touched(target, wanted, keys)
        if self.parts and not touched:
            return
        if not self.parts and scope.join(wanted, list(keys), "left_semi").isEmpty():
            return
        self._replace(target, anti_join(scope, wanted, keys, unique=True), touched)

    def replace(self, df: DataFrame, where: Column) -> None:
        """Put ``df`` in the place of the partitions for which ``where``, a condition on partition columns, holds."""
        target = self._scan()
        self._replace(target, df, target.filter(where).select(*self.parts).distinct().collect())

    def _touched(self, target: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[Row]]:
        """(rows of the partitions that hold a wanted key, those partitions)."""
        if not self.parts:
            return target, []
        columns = list(dict.fromkeys([*keys, *self.parts]))
        hit = target.select(*columns).join(wanted, list(keys), "left_semi").select(*self.parts)
        # One row per partition of the table at most, never one per key.
        touched = hit.distinct().collect()
        return target.filter(in_partitions(touched)), touched

    def _replace(self, target: DataFrame, df: DataFrame, touched: Sequence[Row]) -> None:
        """Stage ``df`` and let it replace the touched partitions, or the whole table if it has none."""
        with written(df, "staged") as staged:
            if not self.parts:
                self._write(staged, "overwrite")
                return
            filled = {tuple(row) for row in staged.select(*self.parts).distinct().collect()}
            emptied = [row for row in touched if tuple(row) not in filled]
            folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1).alias("folder")
            folders = target.filter(in_partitions(emptied)).select(folder).distinct().collect() if emptied else []
            self._write(staged, "overwrite", partitionOverwriteMode="dynamic")
            # Dynamic overwrite leaves a partition that gets no row as it is.
            none = staged.drop(*self.parts).limit(0)
            for row in folders:
                none.write.mode("overwrite").parquet(unquote(row["folder"]))
