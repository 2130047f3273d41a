"""Silver to gold: session features, assembly with its waiting room, training table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions.columns import cast_columns, with_audit, with_partitions
from millrace.functions.joins import anti_join
from millrace.operators.assembly import assemble, overdue_incomplete, presence
from millrace.operators.keyed import matched_count
from millrace.operators.sessions import session_features
from millrace.operators.training_set import training_table
from millrace.plans import clinical as c
from millrace.plans.silver import SKIPPED, WRITTEN, valid_rows
from millrace.plans.store import Store
from millrace.session import written
from millrace.sources.landing import SourceSpec
from millrace.sources.tables import TableMissing


@dataclass(frozen=True)
class ReassemblyResult:
    status: str
    assembled: int = 0
    rescued: int = 0
    quarantined: int = 0


def empty_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """No rows, with every column that a silver table of the feed has."""
    raw = StructType([StructField(name, StringType()) for name in [*spec.types, "source_file"]])
    typed = cast_columns(spark.createDataFrame([], raw), spec.types)
    return with_partitions(with_audit(typed, spec.ts_col), spec.ts_col)


def valid_or_empty(store: Store, spec: SourceSpec) -> DataFrame:
    """Valid rows of a feed; no rows but all columns before its first tick."""
    try:
        return valid_rows(store, spec.name)
    except TableMissing:
        return empty_source(store.spark, spec)


def gait_sessions(gait: DataFrame, split_by_date: bool = False) -> DataFrame:
    """One row of features per walking session."""
    return session_features(
        gait,
        c.SESSION_KEY,
        c.GAIT.ts_col,
        c.SESSION_MEANS,
        c.SESSION_VARIATIONS,
        count=c.SESSION_COUNT,
        split_by_date=split_by_date,
    )


def build_gait_features(store: Store, split_by_date: bool = False) -> str:
    """Rebuild the session features."""
    try:
        gait = valid_rows(store, c.GAIT.name)
    except TableMissing:
        return SKIPPED
    store.gold("gait_features").overwrite(gait_sessions(gait, split_by_date))
    return WRITTEN


def _sides(store: Store) -> dict[str, DataFrame]:
    sessions = gait_sessions(empty_source(store.spark, c.GAIT))
    return {
        "gait": store.gold("gait_features").read_or_empty(sessions.schema),
        "sppb": valid_or_empty(store, c.SPPB),
        "lifestyle": valid_or_empty(store, c.LIFESTYLE),
    }


@dataclass(frozen=True)
class Assembly:
    """How entities are put together: their id, the arrival date of the base, and the tables that hold the results."""

    on: Sequence[str]
    arrival: str
    hidden: Iterable[str] = ()
    assembled: str = "assembled"
    waiting: str = "inference_quarantine"
    latest: Mapping[str, str] | None = None


CLINICAL_ASSEMBLY = Assembly([c.ENTITY], c.ARRIVAL, frozenset(c.SIDE_HIDDEN))


def reassemble(
    store: Store, base: DataFrame, sides: Mapping[str, DataFrame], plan: Assembly, wait_days: int, now: datetime | None = None
) -> ReassemblyResult:
    """Assemble newly complete entities, release complete ones from quarantine, quarantine overdue ones.

    Presence per entity is worked out once and used by all three steps.
    """
    on = list(plan.on)
    assembled, waiting = store.gold(plan.assembled), store.gold(plan.waiting)
    flags = presence({"_base": base, **sides}, on, {"_base": plan.arrival})
    with written(flags, "presence") as known:
        complete = known.filter(reduce(and_, [F.col(f"has_{name}") for name in ("_base", *sides)])).select(*on)
        fresh = anti_join(complete, assembled.read(), on) if assembled.exists() else complete
        n_fresh = fresh.count()
        if n_fresh:
            assembled.append(assemble(base, sides, on, plan.hidden, now=now, ids=fresh, latest=plan.latest))

        rescued, already = 0, None
        if waiting.exists():
            rescued = matched_count(waiting.read(), complete, on).first()["n"]
            if rescued:
                waiting.delete(complete, on)
            already = waiting.read().select(*on)

        overdue = overdue_incomplete(base, sides, on, plan.arrival, wait_days, already, now=now, flags=known)
        with written(overdue, "overdue") as rows:
            n_overdue = rows.count()
            if n_overdue:
                waiting.append(rows)
    return ReassemblyResult(WRITTEN, n_fresh, rescued, n_overdue)


def reassemble_tick(store: Store, wait_days: int = c.WAIT_DAYS, now: datetime | None = None) -> ReassemblyResult:
    """``reassemble`` over the silver tables of the use case."""
    try:
        base = valid_rows(store, c.CLINICAL.name)
    except TableMissing:
        return ReassemblyResult(SKIPPED)
    return reassemble(store, base, _sides(store), CLINICAL_ASSEMBLY, wait_days, now)


def build_training(store: Store) -> str:
    """Rebuild the training table."""
    try:
        base = valid_rows(store, c.CLINICAL.name)
    except TableMissing:
        return SKIPPED
    rows = training_table(
        base, _sides(store), valid_or_empty(store, c.LABELS), [c.ENTITY], c.SIDE_HIDDEN, c.AVAILABLE, c.OBSERVED
    )
    store.gold("training").overwrite(rows)
    return WRITTEN


def run_gold(store: Store, wait_days: int = c.WAIT_DAYS, now: datetime | None = None) -> ReassemblyResult:
    """Features, then assembly, then the training table."""
    build_gait_features(store)
    result = reassemble_tick(store, wait_days, now)
    build_training(store)
    return result
