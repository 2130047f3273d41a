"""Completeness across sources: presence flags, assembly of complete entities, waiting room."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import business_columns
from millrace.functions.joins import any_null, anti_join
from millrace.functions.times import processing_time


def presence(sources: Mapping[str, DataFrame], on: Sequence[str], arrival: Mapping[str, str] | None = None) -> DataFrame:
    """(on..., has_<source>..., first_<source>..., last_<source>...) per id: which sources know it.

    One shuffle of tagged ids, aggregated before it is sent, whatever the number of sources and rows per id.
    ``arrival`` names the date column of those sources whose earliest and latest dates are wanted.
    Rows with a NULL id belong to no entity.
    """
    dates = arrival or {}

    def tagged(name: str, df: DataFrame) -> DataFrame:
        return df.filter(~any_null(on)).select(
            *on,
            *[F.lit(other == name).alias(f"has_{other}") for other in sources],
            *[
                (F.col(date) if other == name else F.lit(None)).cast("date").alias(f"first_{other}")
                for other, date in dates.items()
            ],
        )

    return (
        reduce(DataFrame.unionByName, [tagged(name, df) for name, df in sources.items()])
        .groupBy(*on)
        .agg(
            *[F.bool_or(f"has_{name}").alias(f"has_{name}") for name in sources],
            *[F.min(f"first_{name}").alias(f"first_{name}") for name in dates],
            *[F.max(f"first_{name}").alias(f"last_{name}") for name in dates],
        )
    )


def complete_ids(sources: Mapping[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """Ids present in every source."""
    return presence(sources, on).filter(reduce(and_, [F.col(f"has_{name}") for name in sources])).select(*on)


def assemble(
    base: DataFrame,
    sides: Mapping[str, DataFrame],
    on: Sequence[str],
    hidden: Iterable[str] = (),
    already: DataFrame | None = None,
    now: datetime | None = None,
    ids: DataFrame | None = None,
    latest: Mapping[str, str] | None = None,
    combinations: bool = False,
) -> DataFrame:
    """Wide rows of the ids that are in the base and in every side, without those in ``already``.

    ``hidden`` are the columns of the sides that the row does not take over. An id has one row: of its rows in an input
    the latest by the column that ``latest`` names for it (``_base`` is the base), the greatest otherwise. All inputs are
    read once and meet in one aggregate by id, cut down in every task before it is shuffled. With ``combinations`` an id
    that repeats in several inputs yields every combination of its rows instead. A caller that knows the complete ids
    can pass them as ``ids``.
    """
    keys = list(on)
    inputs = {"_base": (base, business_columns(base, keys))}
    inputs |= {name: (side, business_columns(side, [*keys, *hidden])) for name, side in sides.items()}
    if combinations:
        if ids is None:
            ids = complete_ids({"_base": base, **sides}, on)
        if already is not None:
            ids = anti_join(ids, already, on)
        rows = ids
        for df, columns in inputs.values():
            rows = rows.join(df.select(*keys, *columns), keys)
        return rows.withColumn("assembly_timestamp", processing_time(now))

    def payload(name: str) -> Column:
        """The row of an input, ordered by its time first."""
        time = [F.col(f"`{latest[name]}`").alias("_time")] if latest and name in latest else []
        # Never empty, so that an input without columns of its own is still seen to have the id.
        return F.struct(*time, *[F.col(f"`{c}`") for c in inputs[name][1]], F.lit(True).alias("_has"))

    tagged = [df.filter(~any_null(on)).select(*keys, payload(name).alias(name)) for name, (df, _) in inputs.items()]
    together = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tagged)
    grouped = together.groupBy(*keys).agg(*[F.max(name).alias(name) for name in inputs])
    rows = grouped.filter(reduce(and_, [F.col(name).isNotNull() for name in inputs]))
    if ids is not None:
        rows = rows.join(ids.select(*keys), keys, "left_semi")
    if already is not None:
        rows = anti_join(rows, already, on)
    wide = [F.col(name)[c].alias(c) for name, (_, columns) in inputs.items() for c in columns]
    return rows.select(*keys, *wide, processing_time(now).alias("assembly_timestamp"))


Measures = Mapping[str, tuple[Callable[[Column], Column], str]]


def complete_tagged(rows: DataFrame, on: Sequence[str], tag: str, sources: Sequence[str]) -> DataFrame:
    """Ids present in every source, where all sources are one table told apart by ``tag``."""
    has = [F.bool_or(F.col(tag) == name).alias(f"has_{name}") for name in sources]
    flags = rows.filter(~any_null(on)).groupBy(*on).agg(*has)
    return flags.filter(reduce(and_, [F.col(f"has_{name}") for name in sources])).select(*on)


def assemble_tagged(
    rows: DataFrame,
    on: Sequence[str],
    tag: str,
    sources: Mapping[str, Measures],
    already: DataFrame | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """``assemble`` where all sources are one table: it is read once, and each source gives its measures of an id.

    A measure is an aggregate function and the column that it takes, over the rows of its source.
    """
    here = {name: F.col(tag) == name for name in sources}
    has = [F.bool_or(here[name]).alias(f"has_{name}") for name in sources]
    measures = [f(F.when(here[name], F.col(column))).alias(m) for name, own in sources.items() for m, (f, column) in own.items()]
    grouped = rows.filter(~any_null(on) & F.col(tag).isin(*sources)).groupBy(*on).agg(*has, *measures)
    complete = grouped.filter(reduce(and_, [F.col(f"has_{name}") for name in sources]))
    if already is not None:
        complete = anti_join(complete, already, on)
    names = [m for own in sources.values() for m in own]
    return complete.select(*on, *names, processing_time(now).alias("assembly_timestamp"))


def overdue_incomplete(
    base: DataFrame,
    sides: Mapping[str, DataFrame],
    on: Sequence[str],
    arrival: str,
    wait_days: int,
    already: DataFrame | None = None,
    now: datetime | None = None,
    flags: DataFrame | None = None,
) -> DataFrame:
    """Base rows of ids that arrived ``wait_days`` or more before the newest arrival and still lack a side.

    Adds ``missing_<side>`` flags. Ids in ``already`` are left out. ``flags`` can carry the presence of base and sides
    (with the base named ``_base``) when it is known already.
    """
    missing = {name: ~F.col(f"has_{name}") for name in sides}
    # Presence that is known already knows the newest arrival too; else the base's one column is cheaper to read again.
    newest = base.agg(F.max(arrival).alias("at")) if flags is None else flags.agg(F.max("last__base").alias("at"))
    cutoff = newest.select(F.date_sub("at", wait_days)).scalar()
    if flags is None:
        flags = presence({"_base": base, **sides}, on, {"_base": arrival})
    ids = flags.filter((F.col("first__base") <= cutoff) & reduce(or_, missing.values()))
    ids = ids.select(*on, *[flag.alias(f"missing_{name}") for name, flag in missing.items()])
    if already is not None:
        ids = anti_join(ids, already, on)
    return base.join(ids, list(on)).select(
        *base.columns, *[f"missing_{name}" for name in sides], processing_time(now).alias("quarantine_timestamp")
    )


def fan_out_report(inputs: Mapping[str, DataFrame], on: Sequence[str]) -> DataFrame:
    """(source, n_rows, n_ids, max_rows_per_id) per input: where a join by id multiplies rows."""

    def tagged(name: str, df: DataFrame) -> DataFrame:
        return df.filter(~any_null(on)).select(F.lit(name).alias("source"), *on)

    return (
        reduce(DataFrame.unionByName, [tagged(name, df) for name, df in inputs.items()])
        .groupBy("source", *on)
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("source")
        .agg(
            F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"), F.max("n").alias("max_rows_per_id")
        )
    )

