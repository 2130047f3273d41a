"""Connected components on DataFrames, by alternating large-star and small-star steps.

Every step attaches nodes to the smallest neighbour they know, which halves distances; a node's neighbours are only ever
reduced to a minimum (pre-aggregated before the shuffle) and joined back to its edges, so a hub with many links is split
by adaptive execution like any skewed join, and no neighbourhood meets in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import checkpointed


def _pairs(left: Column | str, right: Column | str) -> list[Column]:
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return [as_column(left).alias("u"), as_column(right).alias("v")]


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood. ``edges`` have u > v."""
    both = edges.unionByName(edges.select(*_pairs("v", "u")))
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("least"))
    return both.filter("v > u").join(least, "u").select(*_pairs("v", "least")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours, and itself, to the smallest of them. ``edges`` have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").filter("v > least").select(*_pairs("v", "least"))
    return moved.unionByName(least.select(*_pairs("u", "least"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node with a link to another; the component is its smallest node.

    Links with a NULL end and links of a node to itself say nothing; repeated links count once; no links give an empty
    table. Rounds end when a round changes nothing; about log2 of the longest shortest path are needed.
    """
    ends = edges.select(*_pairs(F.greatest(left, right), F.least(left, right))).filter(F.col(left) != F.col(right))
    now = checkpointed(ends.distinct())
    state = _state(now)
    for _ in range(max_rounds):
        if not state[0]:
            break
        now = checkpointed(_small_star(_large_star(now)))
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple[int, int | None]:
    """(count, sum of hashes) of the links, to see a change."""
    mixed = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)), F.sum(mixed.cast("decimal(38,0)"))).first()
    return row[0], row[1]
