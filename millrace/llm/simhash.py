"""SimHash near-duplicates of whole texts: word shingles, 64-bit fingerprints, exact tiled comparison.

Distinct fingerprints are dealt into classes by the population counts of their two halves, and classes into sub-classes
of bounded size. Two fingerprints within the radius lie in classes whose counts differ by no more than the radius, so
only such pairs of sub-classes become groups, each of bounded size and compared by one task. Within a group, both sides
are sorted by finer population counts and compared tile by tile with exclusive-or and bit counts; tile pairs whose
counts differ beyond the radius are skipped. No pair within the radius is lost. Links join into components.

Cases: a NULL text is an empty one, and a text without words has fingerprint zero, which links like any other; fewer
words than a shingle has give one shingle of all words; a NULL id takes part with its text and counts as larger than
every id when the smallest is sought; repeated rows are kept; an empty table gives an empty table; only the columns
named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import checkpointed, small, tuned_batches
from millrace.llm.components import connected_components

SEED = 42
RADIUS = 2
SHINGLE = 3
# Fingerprints of a sub-class, at most about so many: bounds a group to twice that.
SUBCLASS = 1 << 15
TILE = 512
CHUNK = 1 << 15


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """Per bit position, how many of the 64-bit hashes have it set."""
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.uint32)
    return total


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text in UTF-8: a bit is 1 if it is set in over half the hashes of the shingles.

    A-Z are lower-cased and ASCII white space separates words; shingles count as often as they occur.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends]
    view = memoryview(joined)
    hashes = np.array([digest(view[a : b - 1], SEED) for a, b in zip(starts, ends[shingle - 1 :])], dtype="<u8")
    bits = set_bits(hashes) * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, fp)``: the fingerprint of every whole text as a signed 64-bit integer."""
    tuned_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(text.as_py(), shingle) for text in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fp long")


def part_counts(values: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit parts, a row each."""
    parts = values.view(np.uint16).reshape(len(values), 4)
    return np.bitwise_count(parts).astype(np.int8)


def linked(left: np.ndarray, right: np.ndarray | None, radius: int, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within the radius, of ``left`` with ``right``, or within ``left`` if ``right`` is None.

    Both sides are sorted by population counts; tile pairs whose ranges of counts lie apart by more than the radius are
    not compared.
    """
    within = right is None

    def arranged(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = part_counts(values)
        order = np.lexsort(counts.T)
        counts, starts = counts[order], range(0, len(values), tile)
        least = np.array([counts[s : s + tile].min(axis=0) for s in starts]).reshape(-1, 4)
        most = np.array([counts[s : s + tile].max(axis=0) for s in starts]).reshape(-1, 4)
        return values[order], least.astype(np.int16), most.astype(np.int16)

    a, a_least, a_most = arranged(left)
    b, b_least, b_most = (a, a_least, a_most) if within else arranged(right)
    firsts, seconds = [], []
    for i in range(len(a_least)):
        apart = np.maximum(0, np.maximum(b_least - a_most[i], a_least[i] - b_most)).sum(axis=1)
        for j in np.flatnonzero(apart <= radius).tolist():
            if within and j < i:
                continue
            x, y = a[i * tile : (i + 1) * tile], b[j * tile : (j + 1) * tile]
            near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            rows, columns = np.nonzero(np.triu(near, 1) if within and i == j else near)
            firsts.append(x[rows])
            seconds.append(y[columns])
    if not firsts:
        return a[:0], a[:0]
    return np.concatenate(firsts), np.concatenate(seconds)


def near_links(prints: DataFrame, radius: int = RADIUS, subclass: int = SUBCLASS) -> DataFrame:
    """``(a, b)``: links between the distinct values of ``fp`` that differ in 1 to ``radius`` bits.

    Within a tile, values are linked to values, not documents: copies are one value.
    """
    half = F.lit(0xFFFFFFFF)
    high = F.bit_count(F.shiftrightunsigned("fp", 32)).cast("int")
    low = F.bit_count(F.col("fp").bitwiseAND(half)).cast("int")
    classed = prints.select("fp", high.alias("high"), low.alias("low"))
    # At most 33 x 33 classes, whatever the data.
    sizes = classed.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"))
    parts = checkpointed(sizes.select("high", "low", F.ceil(F.col("n") / subclass).cast("int").alias("parts")))
    steps = [(x, y) for x in range(-radius, radius + 1) for y in range(-radius, radius + 1)]
    ahead = [(x, y) for x, y in steps if abs(x) + abs(y) <= radius and (x, y) >= (0, 0)]
    offset = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ahead]))
    own = parts.select("*", F.explode(F.expr("sequence(0, parts - 1)")).alias("part")).drop("parts")
    other = own.select(F.col("high").alias("high2"), F.col("low").alias("low2"), F.col("part").alias("part2"))
    tiles = (
        own.select("*", offset.alias("step"))
        .select("high", "low", "part", (F.col("high") + F.col("step.x")).alias("high2"), (F.col("low") + F.col("step.y")).alias("low2"))
        .join(other, ["high2", "low2"])
        .filter((F.col("high") != F.col("high2")) | (F.col("low") != F.col("low2")) | (F.col("part2") >= F.col("part")))
    )
    tile = F.struct("high", "low", "part", "high2", "low2", "part2")
    dealt = classed.join(F.broadcast(parts), ["high", "low"]).select(
        "fp", "high", "low", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int").alias("part")
    )
    alone = (F.col("high") == F.col("high2")) & (F.col("low") == F.col("low2")) & (F.col("part") == F.col("part2"))
    keys = tiles.select("high", "low", "part", tile.alias("tile"), F.lit(False).alias("right"))
    mirrored = tiles.filter(~alone).select(
        F.col("high2").alias("high"), F.col("low2").alias("low"), F.col("part2").alias("part"), tile.alias("tile"), F.lit(True).alias("right")
    )
    spread = dealt.join(keys.unionByName(mirrored), ["high", "low", "part"]).select("tile", "right", "fp", alone_of(F.col("tile")).alias("alone"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy(np.int64).view(np.uint64)
        side = group["right"].to_numpy(bool)
        a, b = linked(values[~side], None if group["alone"].iloc[0] else values[side], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return spread.groupBy("tile").applyInPandas(compare, "a long, b long")


def alone_of(tile):
    """Whether a tile pairs a sub-class with itself."""
    same = [tile[f"{name}"] == tile[f"{name}2"] for name in ("high", "low", "part")]
    return same[0] & same[1] & same[2]


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE
) -> DataFrame:
    """``(id, fp, component, n_links)`` per document: the smallest id that is reachable over links, its own included,
    and the number of other fingerprints that its own is linked to."""
    rows = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    prints = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("least")))
    links = checkpointed(near_links(prints.select("fp"), radius))
    classes = connected_components(links, "a", "b")
    ends = links.select(F.col("a").alias("fp")).unionByName(links.select(F.col("b").alias("fp")))
    counts = ends.groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    root = F.coalesce("component", "fp").alias("root")
    member = prints.join(classes.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", root)
    least = member.groupBy("root").agg(F.min("least").alias("component"))
    found = member.drop("least").join(least, "root").join(counts, "fp", "left")
    return rows.join(found, "fp").select("id", "fp", "component", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` without the documents that are near copies of one with a smaller id; rows that repeat the smallest id
    stay, and so do rows without an id."""
    found = near_duplicates(docs, id_col, text_col, radius, SHINGLE)
    copies = checkpointed(found.filter("id > component").select(F.col("id").alias(id_col)).distinct())
    return docs.join(small(copies, copies.count()), id_col, "left_anti")
