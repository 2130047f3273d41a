"""Declarative quality rules: split into valid and quarantined rows, reports and invariant checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.joins import any_null

NULL_POLICIES = ("fail", "drop")


def _rule_columns(rules: Mapping[str, str]) -> dict[str, Column]:
    if not rules:
        raise ValueError("no rules given")
    return {name: F.expr(constraint) for name, constraint in rules.items()}


def _violated(rule: Column, null_policy: str) -> Column:
    """True where the rule does not hold; an undecided rule counts as violated only under 'fail'."""
    return ~F.coalesce(rule, F.lit(null_policy == "drop"))


def _check_policy(null_policy: str) -> None:
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, not {null_policy!r}")


def failed_rules(rules: Mapping[str, str], null_policy: str = "fail") -> Column:
    """Names of the violated rules of a row, in rule order."""
    columns = _rule_columns(rules)
    return F.array_compact(F.array(*[F.when(_violated(c, null_policy), F.lit(n)) for n, c in columns.items()]))


def all_rules_hold(rules: Mapping[str, str]) -> Column:
    """Conjunction of the rules; NULL where one is undecided and none is false."""
    return reduce(and_, _rule_columns(rules).values())


def split_by_rules(
    df: DataFrame, rules: Mapping[str, str], null_policy: str = "fail"
) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine); quarantine carries ``failed_rules``.

    With 'fail' an undecided (NULL) rule counts as violated, so the two frames partition the input. With 'drop' a row
    with an undecided rule and no false one is in neither frame.
    Both filters are plain conjunctions of the rules, so those on stored columns reach the scan.
    """
    _check_policy(null_policy)
    holds = all_rules_hold(rules)
    rejected = ~F.coalesce(holds, F.lit(False)) if null_policy == "fail" else ~holds
    quarantine = df.filter(rejected).withColumn("failed_rules", failed_rules(rules, null_policy))
    return df.filter(holds), quarantine


def tag_by_rules(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Add ``is_valid`` and ``failed_rules`` (NULL counts as violated): one evaluation for a single partitioned write."""
    tagged = df.withColumn("failed_rules", failed_rules(rules))
    return tagged.withColumn("is_valid", F.size("failed_rules") == 0)


def rule_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(rule, n_rows, n_violations, n_undecided) per rule, in a single pass over the rows."""
    columns = _rule_columns(rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.count_if(~rule).alias("n_violations"),
                F.count_if(rule.isNull()).alias("n_undecided"),
            ).alias(f"r{i}")
            for i, (name, rule) in enumerate(columns.items())
        ],
    )
    rows = F.explode(F.array(*[F.col(f"r{i}") for i in range(len(columns))])).alias("r")
    return counts.select("n_rows", rows).select("r.rule", "n_rows", "r.n_violations", "r.n_undecided")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys used more than once, the largest group, and whether the key is unique."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.count_if(F.col("n") > 1).alias("n_repeated_keys"),
            F.coalesce(F.max("n"), F.lit(0)).alias("max_rows_per_key"),
        )
        .withColumn("is_unique", F.col("n_repeated_keys") == 0)
    )


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n_null) per column, in a single pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "n_null")


def check_subset(df: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keyed rows, those whose key ``reference`` lacks, and whether there are none."""
    total = F.count(F.lit(1))
    ids = df.filter(~any_null(keys)).groupBy(*keys).agg(total.alias("n"))
    known = reference.select(*keys).distinct().withColumn("_known", F.lit(True))
    return (
        ids.join(known, list(keys), "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("n_orphans"),
        )
        .withColumn("is_subset", F.col("n_orphans") == 0)
    )


def check_split(df: DataFrame, rules: Mapping[str, str], null_policy: str = "fail") -> DataFrame:
    """``check_conservation`` of a split by rules, in a single pass over the rows."""
    _check_policy(null_policy)
    holds = all_rules_hold(rules)
    valid, rejected = F.coalesce(holds, F.lit(False)), ~F.coalesce(holds, F.lit(null_policy == "drop"))
    counts = df.agg(F.count(F.lit(1)).alias("n_input"), F.count_if(valid).alias("n_valid"), F.count_if(rejected).alias("n_quarantined"))
    return counts.withColumn("is_conserved", F.col("n_input") == F.col("n_valid") + F.col("n_quarantined"))


def check_conservation(df: DataFrame, valid: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: rows before the split, on either side of it, and whether none was lost or doubled."""
    parts = [("n_input", df), ("n_valid", valid), ("n_quarantined", quarantine)]
    tagged = [part.select(*[F.lit(n == name).alias(n) for n, _ in parts]) for name, part in parts]
    totals = reduce(DataFrame.unionByName, tagged).agg(*[F.count_if(F.col(n)).alias(n) for n, _ in parts])
    return totals.withColumn("is_conserved", F.col("n_input") == F.col("n_valid") + F.col("n_quarantined"))
