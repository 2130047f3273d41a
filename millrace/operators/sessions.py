"""Session features from repeated measurements."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def variation(column: str) -> Column:
    """Coefficient of variation: sample deviation over mean; NULL for one value or a zero mean."""
    return F.try_divide(F.stddev(column), F.mean(column))


def session_features(
    df: DataFrame,
    by: Sequence[str],
    ts_col: str,
    means: Mapping[str, str],
    variations: Mapping[str, str],
    count: str = "n_rows",
    date: str = "session_date",
    split_by_date: bool = False,
) -> DataFrame:
    """One row per session: means, coefficients of variation and a count.

    ``means`` and ``variations`` map output name to input column. A session that runs past midnight stays one row dated
    by its first measurement, unless ``split_by_date`` makes the date part of the key.
    Every aggregate is partial on the map side, so a hot session sends one row per task.
    """
    measures = [
        *[F.mean(source).alias(name) for name, source in means.items()],
        *[variation(source).alias(name) for name, source in variations.items()],
        F.count(F.lit(1)).alias(count),
    ]
    day = F.to_date(ts_col)
    if split_by_date:
        return df.groupBy(*by, day.alias(date)).agg(*measures)
    return df.groupBy(*by).agg(F.min(day).alias(date), *measures).select(*by, date, *means, *variations, count)
