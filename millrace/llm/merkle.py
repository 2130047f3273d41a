"""Merkle manifest of a table: postorder append logs by aligned builders, proofs by closed-form positions.

Every row is a leaf; the leaves of a group, in the order of their ids, are the leaves of one tree, and the roots of the
groups, in the order of the groups, those of the tree above them. Two consecutive nodes become one until one is left; a
node without a neighbour is hashed alone.

A tree is cut into aligned subtrees of ``2 ** LEVELS`` leaves, and each is built by one task, which appends nodes to its
log as they are completed: a leaf, then every node that this leaf completes. The roots of a stage are the leaves of the
next one, until one subtree holds all. Completion order is postorder, so a node's place in a log follows from the sizes
of the subtrees before it (``position``); a proof reads its siblings there and nothing is searched. Proofs are handed
down from the top: those of a subtree's leaves are their siblings in its log and then the proof of its root.

Ids and digests alone are shuffled. A tree of any size is spread over tasks of at most ``2 ** LEVELS`` leaves each; what
a stage leaves to the next is that much smaller.

Cases: NULL values of fields have a mark of their own, so NULL and an empty text are different leaves; NULL ids come
first in their tree, and NULL is a group of its own, before all others; repeated rows are a leaf each, and of equal ids
the order is that of the digests; an empty table gives an empty manifest; of the table's columns only those named are
read, so further ones do not matter; texts of any length are hashed whole, outside Python.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import checkpointed, small, stored

# Levels of the subtree that one task builds.
LEVELS = 10
# First letters of the steps of a proof: the sibling stands on the left, on the right, or there is none.
LEFT, RIGHT, ALONE = "L", "R", "-"


def joined(*parts: str) -> str:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves of a tree that ends in one node."""
    return max(0, leaves - 1).bit_length()


def completed(leaves: int) -> int:
    """Nodes that are complete once so many leaves have been appended."""
    return 2 * leaves - leaves.bit_count()


def position(leaves: int, level: int, index: int) -> int:
    """Place in the log of the ``index``-th node of a level in a tree of so many leaves."""
    end = (index + 1) << level
    if end <= leaves:
        return completed(end - 1) + level
    # A node at the ragged end comes after all whole ones, after those below it that are not whole either.
    trailing = (leaves & -leaves).bit_length() - 1
    return completed(leaves) + level - trailing - 1


def append_log(leaves: Sequence[str], levels: int) -> list[str]:
    """The nodes of a subtree of ``levels`` levels over the leaves, in the order in which they are completed."""
    log: list[str] = []
    waiting = [""] * (levels + 1)
    for i, leaf in enumerate(leaves):
        node, level = leaf, 0
        log.append(node)
        while level < levels and i >> level & 1:
            node, level = joined(waiting[level], node), level + 1
            log.append(node)
        waiting[level] = node
    ragged = ""
    for level in range(levels):
        if len(leaves) % (2 << level):
            whole = waiting[level] if len(leaves) >> level & 1 else ""
            ragged = joined(whole, ragged)
            log.append(ragged)
    return log


def proof(log: Sequence[str], leaves: int, levels: int, index: int) -> list[str]:
    """Steps from a leaf to the root of its subtree, a sibling with its side or ``ALONE`` each."""
    steps = []
    for level in range(levels):
        other = (index >> level) ^ 1
        if other < -(-leaves >> level):
            steps.append((LEFT if other & 1 == 0 else RIGHT) + log[position(leaves, level, other)])
        else:
            steps.append(ALONE)
    return steps


def folded(leaf: str, steps: Sequence[str]) -> str:
    """The root that a leaf has with a proof."""
    for step in steps:
        side, sibling = step[0], step[1:]
        leaf = joined(sibling, leaf) if side == LEFT else joined(leaf, sibling)
    return leaf


def proof_digest(steps: Sequence[str]) -> str:
    """Digest of the siblings of a proof, from the leaf to the root."""
    return joined(*[step[1:] for step in steps])


def leaf_digest(fields: Mapping[str, Column]) -> Column:
    """Digest of a row's fields: ``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    texts = [column.cast("string") for column in fields.values()]
    marked = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*marked), 256)


def group_key(column: Column) -> Column:
    """A group as text without NULLs, in the order of the groups: NULL first, then bytewise."""
    return F.coalesce(F.concat(F.lit("1"), column.cast("string")), F.lit("0"))


def placed(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, the place of a row in its ``tree`` by ``order``, and ``leaves``, the size of the tree.

    Rows are dealt by ranges, counted per range and tree, and numbered within it: no tree meets in one task.
    """
    dealt, _ = stored(rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()), name)
    counts = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("tree")
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("tree", "part", F.coalesce(before, F.lit(0)).alias("start"), F.sum("n").over(whole).alias("leaves"))
    within = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order))
    numbered = dealt.withColumn("within", within).join(starts, ["tree", "part"])
    return numbered.withColumn("idx", F.col("start") + F.col("within") - 1).drop("part", "start", "within")


def in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with the aligned subtree that each belongs to."""
    return nodes.withColumn("block", F.shiftright("idx", levels))


def span(leaves: int, block: int, levels: int) -> tuple[int, int]:
    """(leaves, levels) of an aligned subtree: all levels in a larger tree, else those up to the root."""
    size = 1 << levels
    return min(size, leaves - block * size), levels if leaves > size else height(leaves)


@dataclass
class Stage:
    """Nodes (tree, idx, leaves, digest) and the logs (tree, block, leaves, nodes) of the subtrees over them."""

    nodes: DataFrame
    logs: DataFrame


def grow(nodes: DataFrame, levels: int = LEVELS) -> list[Stage]:
    """The stages over placed nodes: logs of aligned subtrees, then of subtrees over their roots, until one is left."""
    schema = "tree string, block long, leaves long, nodes array<string>"

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("idx")
        tree, block, leaves = (group.column(c)[0].as_py() for c in ("tree", "block", "leaves"))
        log = append_log(group.column("digest").to_pylist(), span(leaves, block, levels)[1])
        return pa.table({"tree": [tree], "block": [block], "leaves": [leaves], "nodes": [log]})

    stages: list[Stage] = []
    while True:
        dealt = in_blocks(nodes, levels).select("tree", "block", "idx", "leaves", "digest")
        logs, _ = stored(dealt.groupBy("tree", "block").applyInArrow(build, schema), "merkle-log")
        stages.append(Stage(nodes, logs))
        larger = logs.filter(F.col("leaves") > (1 << levels))
        if larger.isEmpty():
            return stages
        above = F.ceil(F.col("leaves") / (1 << levels)).cast("long").alias("leaves")
        nodes = larger.select("tree", F.col("block").alias("idx"), above, F.element_at("nodes", -1).alias("digest"))


def tree_roots(stages: Sequence[Stage], levels: int = LEVELS) -> DataFrame:
    """``(tree, digest)`` of the trees."""
    last = [s.logs.filter(F.col("leaves") <= (1 << levels)).select("tree", F.element_at("nodes", -1).alias("digest")) for s in stages]
    return reduce(DataFrame.unionByName, last)


def proved(dealt: DataFrame, logs: DataFrame, keep: Sequence[str], schema: str, levels: int, fold: bool) -> DataFrame:
    """Proofs of the nodes of the subtrees: ``logs`` carry ``above``, the proof of their roots.

    With ``fold``, the digest of the proof and the root that the column ``shown`` has with it instead of the proof.
    """

    def prove(nodes: pa.Table, log: pa.Table) -> pa.Table:
        block, leaves = log.column("block")[0].as_py(), log.column("leaves")[0].as_py()
        own, up = log.column("nodes")[0].as_py(), log.column("above")[0].as_py()
        size, high = span(leaves, block, levels)
        first = block << levels
        paths = [proof(own, size, high, i - first) + up for i in nodes.column("idx").to_pylist()]
        columns = {c: nodes.column(c) for c in keep}
        if fold:
            columns["proof_sha256"] = pa.array([proof_digest(p) for p in paths], pa.string())
            columns["folded_root"] = pa.array([folded(x, p) for x, p in zip(nodes.column("shown").to_pylist(), paths)], pa.string())
        else:
            columns["path"] = pa.array(paths, pa.list_(pa.string()))
        return pa.table(columns)

    return dealt.groupBy("tree", "block").cogroup(logs.groupBy("tree", "block")).applyInArrow(prove, schema)


def handed_down(stages: Sequence[Stage], top: DataFrame | None, levels: int = LEVELS) -> DataFrame:
    """The logs of the lowest stage with ``above``; ``top`` is (tree, above), None if the trees have nothing above."""
    paths, logs = None, stages[0].logs
    for stage in reversed(stages):
        whole = stage.logs.filter(F.col("leaves") <= (1 << levels))
        if top is None:
            logs = whole.withColumn("above", F.array().cast("array<string>"))
        else:
            logs = whole.join(top, "tree")
        if paths is not None:
            logs = logs.unionByName(stage.logs.join(paths, ["tree", "block"]).select(*logs.columns))
        if stage is not stages[0]:
            dealt = in_blocks(stage.nodes, levels).select("tree", "block", "idx")
            found = proved(dealt, logs, ["tree", "idx"], "tree string, idx long, path array<string>", levels, fold=False)
            paths = found.select("tree", F.col("idx").alias("block"), F.col("path").alias("above"))
    return logs


@dataclass
class Manifest:
    """Leaves of a table and the logs of their trees; ``top`` are the stages of the tree over the trees."""

    leaves: DataFrame
    stages: list[Stage]
    top: list[Stage]
    levels: int

    def subroots(self) -> DataFrame:
        """``(tree, subroot)``."""
        return tree_roots(self.stages, self.levels).withColumnRenamed("digest", "subroot")

    def root(self) -> DataFrame:
        """One row ``root``; none for an empty table."""
        return tree_roots(self.top, self.levels).select(F.col("digest").alias("root"))

    def _top_paths(self) -> DataFrame:
        """``(tree, above)``: the proofs of the roots of the trees."""
        dealt = in_blocks(self.top[0].nodes, self.levels).select("tree", "block", "idx", "member")
        logs = handed_down(self.top, None, self.levels)
        found = proved(dealt, logs, ["member"], "member string, path array<string>", self.levels, fold=False)
        return found.select(F.col("member").alias("tree"), F.col("path").alias("above"))

    def _dealt(self) -> tuple[DataFrame, DataFrame]:
        logs = handed_down(self.stages, self._top_paths(), self.levels).drop("leaves")
        counted = logs.join(self.stages[0].logs.select("tree", "block", "leaves"), ["tree", "block"])
        return in_blocks(self.leaves, self.levels).drop("leaves"), counted

    def proofs(self) -> DataFrame:
        """``(id, tree, idx, digest, path)``: the proof of every leaf, as steps to the root of all."""
        dealt, logs = self._dealt()
        kind = self.leaves.schema["id"].dataType.simpleString()
        schema = f"id {kind}, tree string, idx long, digest string, path array<string>"
        return proved(dealt, logs, ["id", "tree", "idx", "digest"], schema, self.levels, fold=False)

    def audited(self) -> DataFrame:
        """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)``: every row as shown against the manifest."""
        dealt, logs = self._dealt()
        kind = self.leaves.schema["id"].dataType.simpleString()
        schema = f"id {kind}, tree string, digest string, proof_sha256 string, folded_root string"
        found = proved(dealt, logs, ["id", "tree", "digest"], schema, self.levels, fold=True)
        root = self.root().agg(F.first("root")).scalar()
        subroots = checkpointed(self.subroots())
        return found.join(small(subroots, subroots.count()), "tree").select(
            "id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), "proof_sha256", "folded_root",
            (F.col("folded_root") == root).alias("verified"),
        )

    def log_entries(self) -> DataFrame:
        """``(tree, position, digest)``: the logs of the lower trees as one log each, without gaps.

        Positions are those in the whole tree; the leaves of a higher stage are in the log of the stage below.
        """
        levels = self.levels

        def entries(stage: int, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low = stage * levels
            for batch in tables:
                for row in batch.to_pylist():
                    size, high = span(row["leaves"], row["block"], levels)
                    places, digests = [], []
                    for level in range(1 if stage else 0, high + 1):
                        for i in range(-(-size >> level)):
                            index = (row["block"] << (levels - level)) + i
                            places.append(position(row["total"], low + level, index))
                            digests.append(row["nodes"][position(size, level, i)])
                    yield pa.RecordBatch.from_pydict({"tree": [row["tree"]] * len(places), "position": places, "digest": digests})

        totals = self.stages[0].logs.groupBy("tree").agg(F.max("leaves").alias("total"))
        tables = [
            stage.logs.join(totals, "tree").mapInArrow(lambda rows, s=s: entries(s, rows), "tree string, position long, digest string")
            for s, stage in enumerate(self.stages)
        ]
        return reduce(DataFrame.unionByName, tables)


def build_manifest(
    docs: DataFrame, fields: Sequence[str], group_col: str, id_col: str, shown: Mapping[str, Column] | None = None, levels: int = LEVELS
) -> Manifest:
    """The manifest of a table: a leaf per row over ``fields``, a tree per value of ``group_col`` by ``id_col``.

    ``shown`` are the fields that the row to be checked against the manifest has otherwise.
    """
    own = {name: F.col(f"`{name}`") for name in fields}
    leaf = leaf_digest(own)
    # Only where a field differs is a second digest needed.
    changed = [~F.col(f"`{name}`").eqNullSafe(column) for name, column in (shown or {}).items()]
    other = F.when(reduce(Column.__or__, changed), leaf_digest(own | dict(shown))) if changed else F.lit(None).cast("string")
    group = F.col(f"`{group_col}`")
    rows = docs.select(group_key(group).alias("tree"), F.col(f"`{id_col}`").alias("id"), leaf.alias("digest"), other.alias("other"))
    # The number keeps rows that are equal in everything apart, so that ranges can split them.
    rows, _ = stored(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-rows")
    ordered = placed(rows, ["id", "digest", "row"], "merkle-dealt")
    leaves, _ = stored(ordered.withColumn("shown", F.coalesce("other", "digest")).drop("other", "row"), "merkle-leaves")
    stages = grow(leaves, levels)
    members = tree_roots(stages, levels).select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
    above, _ = stored(placed(members, ["member"], "merkle-trees"), "merkle-top")
    return Manifest(leaves, stages, grow(above, levels), levels)


def audit(
    docs: DataFrame, fields: Sequence[str], group_col: str, id_col: str, shown: Mapping[str, Column] | None = None, levels: int = LEVELS
) -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per row of the table."""
    return build_manifest(docs, fields, group_col, id_col, shown, levels).audited()
