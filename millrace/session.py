"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings only: cluster sizing stays with whoever starts the session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key in a chain of joins on one id is worth the extra shuffle that splitting it costs.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Pin UTC and switch on the adaptive rules that split skewed partitions; returns the session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one is made only for a local session without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def hadoop_fs(spark: SparkSession, path: str):
    """(file system, Path) of ``path`` in the session's Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


@contextmanager
def written(df: DataFrame, name: str = "written") -> Iterator[DataFrame]:
    """Cut the lineage of ``df`` by a parquet table in the scratch folder, removed on exit.

    Unlike a cached block the table outlives lost executors, so a retry never repeats the upstream work.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        fs, target = hadoop_fs(spark, path)
        fs.delete(target, True)
