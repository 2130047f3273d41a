"""Rows dealt by ranges of their order: what a running value over all of them needs instead of one sorted task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_path


def dealt_by_range(df: DataFrame, order: Sequence[Column | str], name: str) -> DataFrame:
    """``df`` with ``part``, the number of a row's stretch: rows of a smaller number come first in the order.

    Equal rows share a stretch, larger groups lie in several. The rows are written to the scratch folder, since ranges
    are cut from a sample and would be cut otherwise the next time.
    """
    path = scratch_path(df.sparkSession, name)
    dealt = df.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)
