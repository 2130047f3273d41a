"""Join helpers for keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def any_null(columns: Sequence[str]) -> Column:
    """True where at least one of the columns is NULL."""
    return reduce(or_, [F.col(c).isNull() for c in columns])


def anti_join(left: DataFrame, right: DataFrame, on: Sequence[str], unique: bool = False) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``; NULL keys match nothing and stay.

    The keys of ``right`` are made distinct before they are shuffled, so that a key that repeats there without end
    arrives once per task; ``unique`` says that they are distinct already. A key that is hot in ``left``, NULL included,
    is split by adaptive execution.
    """
    keys = list(on)
    other = right.select(*keys) if unique else right.select(*keys).distinct()
    return left.join(other, keys, "left_anti")
