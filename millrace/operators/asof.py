"""As-of join: for every row the latest row of another table on or before its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranges import dealt_by_range


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, columns: Sequence[str]) -> DataFrame:
    """``left`` with ``columns`` of the latest row of ``right`` that has its id and is not later; NULL where there is none.

    Both sides become one sequence by id and time, the right rows first among equals, and each left row takes the last
    right row before it: one shuffle and no range join. The sequence is dealt by ranges, so a hot id lies in several
    tasks; a stretch begins with the last right row of the stretches before it, of which there is one row per task and
    id. Of right rows with one id and time the one with the greatest ``columns`` counts. Rows with a NULL id or time find
    nothing.
    """
    keys, no_payload = list(on), F.lit(None)
    clash = set(columns) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    of_right = right.select(*[F.col(c).alias(c) for c in keys], F.col(right_time).alias("_time"), F.struct(*columns).alias("_last"))
    of_left = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"), *keys, F.col(left_time).alias("_time"))
    known = of_right.na.drop(subset=[*keys, "_time"]).groupBy(*keys, "_time").agg(F.max("_last").alias("_last"))
    sequence = known.select(*keys, "_time", F.lit(0).alias("_side"), "_last", no_payload.cast(of_left.schema["_row"].dataType).alias("_row"))
    sequence = sequence.unionByName(
        of_left.select(*keys, "_time", F.lit(1).alias("_side"), no_payload.cast(known.schema["_last"].dataType).alias("_last"), "_row")
    )
    # Rows of one id and time may be many: a number spreads them over stretches.
    numbered = sequence.withColumn("_number", F.monotonically_increasing_id())
    dealt = dealt_by_range(numbered, [*keys, "_time", "_side", "_number"], "asof")

    stretches = dealt.filter("_side = 0").groupBy(*keys, "part").agg(F.max_by("_last", "_time").alias("_end"))
    parts = dealt.select(*keys, "part").distinct()
    ends = parts.join(stretches, [*keys, "part"], "left")
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*keys, "part", F.last("_end", ignorenulls=True).over(before).alias("_start")).filter("_start IS NOT NULL")

    upto = Window.partitionBy(*keys, "part").orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = dealt.withColumn("_own", F.last("_last", ignorenulls=True).over(upto)).filter("_side = 1")
    found = F.when(F.col("_time").isNotNull(), F.coalesce("_own", "_start"))
    joined = own.join(starts, [*keys, "part"], "left").select("_row", found.alias("_found"))
    return joined.select("_row.*", *[F.col("_found")[c].alias(c) for c in columns])
