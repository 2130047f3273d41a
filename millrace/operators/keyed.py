"""Keyed operators: latest row per key, upsert, delete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from millrace.functions.joins import any_null, anti_join


def _other_columns(df: DataFrame, used: Sequence[str]) -> list[str]:
    """Orderable columns outside ``used``: sorting by them too makes equal ranks equal rows."""
    return [f.name for f in df.schema.fields if f.name not in used and not isinstance(f.dataType, MapType | VariantType)]


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: str, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the latest by ``order_by``, ties broken by ``tiebreak`` (default: all other columns).

    ``row_number() = 1`` is cut per input partition before the shuffle, so a hot key sends one row per task.
    Rows with a NULL key equal no other row and are all kept: each is a group of its own, spread over all tasks.
    """
    ties = _other_columns(df, [*keys, order_by]) if tiebreak is None else tiebreak
    order = [F.col(c).desc_nulls_last() for c in (order_by, *ties)]
    nullable = [f.name for f in df.schema.fields if f.name in keys and f.nullable]
    own = [F.when(any_null(nullable), F.monotonically_increasing_id()).otherwise(F.lit(-1)).alias("_own")] if nullable else []
    window = Window.partitionBy(*keys, *(["_own"] if own else [])).orderBy(*order)
    ranked = df.select("*", *own).withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).select(*df.columns)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update-all / insert-all: rows of ``target`` whose key is not in ``source``, then all of ``source``.

    ``source`` must be unique on ``keys``. NULL keys match nothing, so their rows are inserted.
    """
    return anti_join(target, source, keys, unique=True).unionByName(source, allowMissingColumns=True)


def delete_matched(target: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``keys_df``."""
    return anti_join(target, keys_df, on)


def matched_count(target: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row ``n``: rows of ``target`` whose key is in ``keys_df``."""
    return target.join(keys_df.select(*on).distinct(), list(on), "left_semi").agg(F.count(F.lit(1)).alias("n"))


def left_join_all(base: DataFrame, sides: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Left join several sides to ``base`` on one key.

    Every input is shuffled by that key once, or not at all where it is already partitioned by it or small enough to
    be broadcast. Base rows with a NULL key stay without a partner.
    """
    for side in sides:
        base = base.join(side, list(on), "left")
    return base
