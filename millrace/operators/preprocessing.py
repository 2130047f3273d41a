"""Imputation, encoding, scaling and class weights as plain projections with fitted constants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.quantiles import exact_medians
from millrace.operators.ranges import dealt_by_range

def mode(df: DataFrame, column: str):
    """Most frequent value, the smallest on ties; None when there is none."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    row = counts.orderBy(F.col("count").desc(), F.col(column).asc()).first()
    return None if row is None else row[column]


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value of each text column, the smallest on ties, in one pass whatever the number of values."""
    if not columns:
        return {}
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "c", "v")
    counts = long.filter(F.col("v").isNotNull()).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("v")).collect()
    return {**dict.fromkeys(columns), **{row["c"]: row["v"] for row in rows}}


def category_table(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the dictionary of a categorical column, its distinct values numbered in sorted order from 0.

    Values are dealt by ranges, numbered within each and moved up by the sizes of the ranges before, so there may be any
    number of them.
    """
    values = df.select(F.col(f"`{column}`").cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    dealt = dealt_by_range(values, ["value"], "categories")
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per task
    starts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
    numbered = dealt.withColumn("within", within).join(starts, "part")
    return numbered.select("value", (F.col("start") + F.col("within")).cast("int").alias("code"))


def impute_values(
    df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()
) -> dict[str, float | str | None]:
    """Fill values: exact median of numeric columns, mode of categorical ones."""
    return {**exact_medians(df, numeric), **modes(df, categorical)}


def impute(df: DataFrame, values: Mapping[str, float | str | None]) -> DataFrame:
    """Replace NULLs in one projection; numeric columns become doubles."""

    def filled(name: str) -> Column:
        value = values[name]
        if value is None:
            return F.col(name)
        column = F.col(name) if isinstance(value, str) else F.col(name).cast("double")
        return F.coalesce(column, F.lit(value)).alias(name)

    return df.select(*[filled(c) if c in values else F.col(c) for c in df.columns])


def ordinal_encode(df: DataFrame, column: str, output: str, known: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Add the code of a column by a dictionary (its own by default, or sorted values); -1 for an unseen or missing value.

    The dictionary is joined, so it may be as large as the table; Spark broadcasts it where it is small.
    """
    if known is None:
        known = category_table(df, column)
    elif not isinstance(known, DataFrame):
        rows = [(v, i) for i, v in enumerate(known)]
        known = df.sparkSession.createDataFrame(rows, "value STRING, code INT")
    codes = known.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.join(codes, F.col(f"`{column}`").cast("string") == F.col("_value"), "left")
    return joined.withColumn(output, F.coalesce("_code", F.lit(-1))).drop("_value", "_code")


def scale_values(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population deviation) per column in one pass; a constant column gets deviation 1."""
    if not columns:
        return {}
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def standardize(df: DataFrame, columns: Sequence[str], values: Mapping[str, tuple[float, float]] | None = None):
    """Replace columns by (x - mean) / deviation."""
    fitted = scale_values(df, columns) if values is None else values
    scaled = {c: (F.col(c).cast("double") - F.lit(fitted[c][0])) / F.lit(fitted[c][1]) for c in columns}
    return df.withColumns(scaled) if scaled else df


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight n_all / (n_classes * n); the groups are the classes."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).alias("t")).scalar()
    return counts.withColumn("_t", totals).select(
        label, "n", (F.col("_t.rows") / (F.col("_t.classes") * F.col("n"))).alias("weight")
    )
