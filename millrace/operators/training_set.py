"""Training rows: leakage-safe labels, wide left join, temporal split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import business_columns
from millrace.operators.keyed import dedup_latest, left_join_all

SPLITS = ("train", "val", "test")


def antileakage(labels: DataFrame, available: str, observed: str) -> DataFrame:
    """Labels that became known after the observation; unchanged when the column is absent."""
    return labels.filter(F.col(available) > F.col(observed)) if available in labels.columns else labels


def training_table(
    base: DataFrame,
    sides: Mapping[str, DataFrame],
    labels: DataFrame,
    on: Sequence[str],
    hidden: Iterable[str] = (),
    available: str = "label_available_date",
    observed: str = "snapshot_date",
    label_on: Sequence[str] | None = None,
    latest: Mapping[str, str] | None = None,
) -> DataFrame:
    """Every base row with its side features and leakage-clean label; missing ones stay NULL.

    A label belongs to an observation: ``label_on`` is ``on`` and ``observed`` where both base and labels have that
    column, so a row of a repeat id gets no label of another of its dates. Where labels have no observation of their own
    they are joined by ``on`` and, if the base has one, kept only where they became known after it.

    A repeat id of a side multiplies rows, unless ``latest`` names the column by which its latest row is taken.

    ``hidden`` are columns that neither sides nor labels contribute (audit columns, other ids and dates).
    """
    keys = list(on)
    single = {name: dedup_latest(side, keys, latest[name]) if latest and name in latest else side for name, side in sides.items()}
    joined = [side.select(*keys, *business_columns(side, [*keys, *hidden])) for side in single.values()]
    if label_on is None:
        label_on = [*keys, observed] if observed in base.columns and observed in labels.columns else keys
    label_keys = list(label_on)
    clean = antileakage(labels, available, observed) if observed in labels.columns else labels
    clean = clean.select(*label_keys, *business_columns(clean, [*label_keys, *keys, *hidden, observed]))
    rows = left_join_all(left_join_all(base, joined, keys), [clean], label_keys)
    if observed in label_keys or observed not in base.columns or available not in clean.columns:
        return rows.select(*_order(base, joined, clean, keys, label_keys))
    known = F.col(available) > F.col(observed)
    named = [c for c in clean.columns if c not in label_keys]
    return rows.withColumns({c: F.when(known, F.col(c)) for c in named}).select(*_order(base, joined, clean, keys, label_keys))


def _order(base: DataFrame, sides: Sequence[DataFrame], labels: DataFrame, on: Sequence[str], label_on: Sequence[str]) -> list[str]:
    """Columns of the base, of the sides, of the labels."""
    return [*base.columns, *[c for s in sides for c in s.columns if c not in on], *[c for c in labels.columns if c not in label_on]]


def labeled_only(df: DataFrame, label: str) -> DataFrame:
    """Rows with a known label."""
    return df.filter(F.col(label).isNotNull())


def label_coverage(df: DataFrame, label: str) -> DataFrame:
    """One row: labelled and excluded rows."""
    known = F.col(label).isNotNull()
    return df.agg(F.count_if(known).alias("n_labeled"), F.count_if(~known).alias("n_excluded"))


def cutoff_dates(df: DataFrame, date_col: str, fractions: Sequence[float] = (0.7, 0.9)) -> list[date | None]:
    """Exact interpolated percentiles of a date column, rounded to the second and truncated to a day.

    Dates are counted first: what reaches the single percentile task is one row per calendar day.
    """
    seconds = (F.unix_date("day") * 86400).cast("double")
    days = df.select(F.to_date(date_col).alias("day")).filter(F.col("day").isNotNull()).groupBy("day").count()
    row = (
        days.agg(F.percentile(seconds, [float(f) for f in fractions], F.col("count")).alias("p"))
        .select(F.transform("p", lambda p: F.date_from_unix_date(F.floor(F.round(p) / 86400).cast("int"))).alias("cuts"))
        .first()
    )
    return list(row["cuts"]) if row["cuts"] is not None else [None for _ in fractions]


def split_column(date_col: str, train_end: date, val_end: date) -> Column:
    """'train' up to and including ``train_end``, 'val' up to and including ``val_end``, then 'test'."""
    day = F.to_date(date_col)
    return (
        F.when(day <= F.lit(train_end), "train").when(day <= F.lit(val_end), "val").when(day > F.lit(val_end), "test")
    )


def temporal_split(df: DataFrame, date_col: str, fractions: Sequence[float] = (0.7, 0.9)) -> DataFrame:
    """Add ``split``, cut at percentiles of the dates present; rows without a date get NULL."""
    train_end, val_end = cutoff_dates(df, date_col, fractions)
    if train_end is None:
        return df.withColumn("split", F.lit(None).cast("string"))
    return df.withColumn("split", split_column(date_col, train_end, val_end))


def split_summary(df: DataFrame, date_col: str, label: str) -> DataFrame:
    """(split, n, min_date, max_date, prevalence)."""
    return (
        df.filter(F.col("split").isNotNull())
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.to_date(date_col)).alias("min_date"),
            F.max(F.to_date(date_col)).alias("max_date"),
            F.avg(F.col(label).cast("double")).alias("prevalence"),
        )
    )
