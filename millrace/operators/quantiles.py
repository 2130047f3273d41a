"""Exact medians by counting the bits of doubles: no column is sorted, collected or sampled."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits of a double that a pass decides: it counts at most 2 ** BITS values per column and rank.
BITS = 16
PASSES = 64 // BITS


def ordered_bits(value: Column) -> Column:
    """The bits of a double as a 64-bit integer in the order of the doubles; both zeros are 0, NaN is the greatest."""
    size = F.coalesce(F.abs(value), F.lit(0.0))
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), size).cast("long")
    return F.when(value < 0, -bits).when(value.isNotNull(), bits)


@dataclass
class _Rank:
    """A wanted row of a column in sorted order: ``rank`` counts within the values that begin with ``prefix``."""

    column: int
    upper: bool
    prefix: int = 0
    rank: int | None = None
    value: float | None = None


def _digits(numbers: DataFrame, ranks: Sequence[_Rank], done: int) -> DataFrame:
    """(column, prefix, digit, n, low, high): the values that begin with a wanted prefix by their next digit."""
    entries = []
    for column in sorted({r.column for r in ranks}):
        value, bits = F.col(f"v{column}"), F.col(f"b{column}")
        prefix = F.shiftright(bits, 64 - done) if done else F.lit(0).cast("long")
        digit = F.shiftright(bits, 64 - done - BITS)
        wanted = prefix.isin([r.prefix for r in ranks if r.column == column]) if done else F.lit(True)
        entry = F.struct(F.lit(column).alias("column"), prefix.alias("prefix"), digit.alias("digit"), value.alias("value"))
        entries.append(F.when(value.isNotNull() & wanted, entry))
    rows = numbers.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    return rows.groupBy("column", "prefix", "digit").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median per numeric column (mean of the two middle values; NULLs ignored, NaN the greatest value).

    Values are counted by the first 16 of their ordered bits, then those that begin like the wanted one by the next 16,
    and so on: four passes at most, fewer where all values that begin alike are equal. Each pass is an aggregate of at
    most 65,536 rows per column and rank, cut down in every task before it is shuffled, whatever the values are.
    """
    names = list(columns)
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    numbers = values.select("*", *[ordered_bits(F.col(f"v{i}")).alias(f"b{i}") for i in range(len(names))])
    ranks = [_Rank(i, upper) for i in range(len(names)) for upper in (False, True)]
    open_ = ranks
    for step in range(PASSES):
        if not open_:
            break
        whole = Window.partitionBy("column", "prefix")
        upto = whole.orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = _digits(numbers, open_, step * BITS).select(
            "*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total")
        )
        holds = []
        for r in open_:
            rank = F.floor((F.col("total") - (0 if r.upper else 1)) / 2) if r.rank is None else F.lit(r.rank)
            here = (F.col("column") == r.column) & (F.col("prefix") == r.prefix)
            holds.append(here & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank))
        found = sums.filter(reduce(or_, holds)).collect()  # at most one row per wanted rank
        for r in open_:
            for row in found:
                if (row["column"], row["prefix"]) != (r.column, r.prefix):
                    continue
                rank = (row["total"] - (0 if r.upper else 1)) // 2 if r.rank is None else r.rank
                if row["upto"] - row["n"] <= rank < row["upto"]:
                    r.prefix, r.rank = row["digit"], rank - (row["upto"] - row["n"])
                    if row["low"] == row["high"] or step == PASSES - 1:
                        r.value = row["low"]
                    break
            else:
                r.rank = None  # a column without values
        open_ = [r for r in open_ if r.rank is not None and r.value is None]
    middle = {(r.column, r.upper): r.value for r in ranks}
    pairs = {c: (middle[i, False], middle[i, True]) for i, c in enumerate(names)}
    return {c: None if low is None or high is None else low if low == high else (low + high) / 2 for c, (low, high) in pairs.items()}
