"""Helpers of the corpus operators: output names, intermediate tables in the shared folder, tables of a checked size."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import hadoop_fs, scratch_dir, scratch_path

# Rows of a batch that is handed to Python: whole texts are long, so far below Spark's default.
BATCH_ROWS = 1_000
# A table is broadcast only if it has been counted and has at most so many rows of a few dozen bytes.
BROADCAST_ROWS = 100_000


def tuned_batches(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a worker holds few whole texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it is not installed: it is sent along once per context."""
    sc, name = spark.sparkContext, "millrace_package.zip"
    if name not in sc._python_includes:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="millrace-"), name.removesuffix(".zip"))
        sc.addPyFile(shutil.make_archive(base, "zip", root, "millrace"))
    return spark


def no_clash(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ValueError if the table has a column named like an output."""
    clash = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"columns of the table clash with outputs: {sorted(clash)}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage through the cluster's shared checkpoint folder; for narrow rows."""
    sc = df.sparkSession.sparkContext
    folder = scratch_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(the rows read back, path): a parquet table in the shared folder, for rows that are read more than once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table made by ``stored``."""
    fs, target = hadoop_fs(spark, path)
    fs.delete(target, True)


@contextmanager
def swept_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go when it ends; for jobs whose every query writes a table or a checkpoint."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, to be broadcast if its counted ``rows`` are few enough, else to be joined as Spark sees fit."""
    return F.broadcast(df) if rows <= most else df
