"""Bronze to silver: types, quality rules, valid and quarantined rows in one write."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from millrace.functions.columns import cast_columns
from millrace.operators.quality import tag_by_rules
from millrace.plans.store import BY_MONTH, Store
from millrace.sources.landing import REASON, SourceSpec
from millrace.sources.tables import ParquetTable, TableMissing, in_partitions

SKIPPED, UNCHANGED, WRITTEN = "SKIPPED", "UNCHANGED", "WRITTEN"


def refine(bronze: DataFrame, spec: SourceSpec, rules: Mapping[str, str]) -> DataFrame:
    """Typed rows with ``is_valid`` and ``failed_rules``."""
    return tag_by_rules(cast_columns(bronze, spec.types), rules)


def months_of(bronze: ParquetTable) -> DataFrame:
    """(year, month, n, modified) per month of a table, from file metadata alone."""
    changed = F.max(F.unix_millis("_metadata.file_modification_time")).alias("modified")
    return bronze.read().groupBy(*BY_MONTH).agg(F.count(F.lit(1)).alias("n"), changed)


def refine_source(store: Store, spec: SourceSpec, rules: Mapping[str, str]) -> str:
    """Rebuild the silver table of a source; rows are evaluated once and written once.

    A control table has the state of each month of bronze, and the types and rules, that silver was built from. Months
    that have changed since are evaluated again and replaced; a change of types or rules rebuilds the table. A row stays in
    the month it has in bronze.
    """
    bronze, silver = store.bronze(spec.name), store.silver(spec.name)
    control = store.control(f"silver_{spec.name}")
    try:
        rows = bronze.read()
    except TableMissing:
        return SKIPPED
    recipe = hashlib.sha256(json.dumps([spec.types, dict(rules)]).encode()).hexdigest()
    now = {tuple(r)[:2]: tuple(r)[2:] for r in months_of(bronze).collect()}
    before = {tuple(r)[:2]: tuple(r)[2:4] for r in control.read().filter(F.col("recipe") == recipe).collect()} if control.exists() else {}
    if now == before:
        return UNCHANGED
    changed = [Row(year=m[0], month=m[1]) for m in now.keys() | before.keys() if now.get(m) != before.get(m)]
    if before:
        silver.replace(refine(rows.filter(in_partitions(changed)), spec, rules), in_partitions(changed))
    else:
        silver.overwrite(refine(rows, spec, rules))
    state = [(*month, *seen, recipe) for month, seen in sorted(now.items(), key=repr)]
    control.overwrite(store.spark.createDataFrame(state, "year INT, month INT, n LONG, modified LONG, recipe STRING").coalesce(1))
    return WRITTEN


def valid_rows(store: Store, source: str) -> DataFrame:
    """Rows of a silver table that pass every rule; reads only their partitions."""
    return store.silver(source).read().filter("is_valid").drop("is_valid", "failed_rules")


def rejected_rows(store: Store, source: str) -> DataFrame | None:
    """Rows of a source that could not be read, as text, with their reason as the failed rule; None if there are none."""
    try:
        rows = store.rejected(source).read()
    except TableMissing:
        return None
    return rows.withColumn("failed_rules", F.array(REASON)).drop(REASON)


def quarantined_rows(store: Store, source: str) -> DataFrame:
    """Rows that fail a rule or could not be read, with ``failed_rules``.

    Of unreadable rows, columns keep what fits their type, and ``watermark_text`` and ``corrupt_record`` what was there.
    """
    rejected = rejected_rows(store, source)
    try:
        rows = store.silver(source).read().filter(~F.col("is_valid")).drop("is_valid")
    except TableMissing:
        if rejected is None:
            raise
        return rejected
    if rejected is None:
        return rows
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    texts = [F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds and c != "failed_rules" else F.col(f"`{c}`") for c in rejected.columns]
    return rows.unionByName(rejected.select(*texts), allowMissingColumns=True)


def silver_counts(store: Store, source: str) -> dict[str, int]:
    """Valid and quarantined rows of a source, those that could not be read among the latter."""
    rows = store.silver(source).read().groupBy("is_valid").count().collect()
    counts = {row["is_valid"]: row["count"] for row in rows}
    rejected = rejected_rows(store, source)
    lost = 0 if rejected is None else rejected.count()
    return {"valid": counts.get(True, 0), "quarantined": counts.get(False, 0) + lost}
