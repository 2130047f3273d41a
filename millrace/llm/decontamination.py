"""Benchmark decontamination: a BM25 index of test items with block-max WAND, queried by every training passage.

Items are indexed with their BM25 term weights as shares of the item's score for itself, so a passage's score says how
much of the item it covers, and one threshold serves all items. Items are sorted by length and cut into blocks. For a
passage, the sum of its terms' maxima bounds every block; blocks below the threshold are skipped without reading a
posting, the others are searched by WAND, and all items above the threshold are retrieved. A retrieved item is verified:
its question (all sentences but the last) and its answer (the last sentence; none if there is only one) must each be
covered by the passage to ``overlap`` of their word shingles.

Passages are windows of twice the longest item's length, half overlapping, over the whole text, so every occurrence of an
item lies within one. The index holds the query set of test items, not the corpus; it is cut into shards, and each scan
of the documents takes as many shards as ``CELLS_PER_SCAN`` allows, so tasks hold a bounded part whatever the number of
items.

Cases: NULL or empty texts, of documents or items, match nothing; items with the same text are each reported; a document
row that repeats gives repeated matches; NULL ids are passed through; empty tables give no matches; further columns are
not read. Words are lower-cased and lose punctuation at their ends; words of nothing else are left out.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import checkpointed, small, tuned_batches

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 4
SHARD_ITEMS = 1_024
# Cells of block maxima (terms x blocks) that one scan may hold, in float32.
CELLS_PER_SCAN = 1 << 24
PASSAGES_AT_ONCE = 512
MAX_REMEMBERED = 1 << 19
EDGES = re.compile(r"^\W+|\W+$")
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
OTHER, NOTHING = -1, -2


def term_of(word: str) -> str:
    return EDGES.sub("", word)


def terms_of(text: str | None) -> list[str]:
    """Words in order, lower-cased, without punctuation at their ends."""
    return [term for term in map(term_of, (text or "").lower().split()) if term]


def shingles(terms: list[str], size: int) -> set[tuple[str, ...]]:
    return {tuple(terms[i : i + size]) for i in range(len(terms) - size + 1)}


def coverage(part: list[str], passage: list[str]) -> float:
    """Share of the part's shingles that the passage has; parts shorter than a shingle are one; 1 for no words."""
    if not part:
        return 1.0
    size = min(SHINGLE, len(part))
    own = shingles(part, size)
    return len(own & shingles(passage, size)) / len(own)


@dataclass
class Item:
    """A test item: its place in the given order, its terms, and the same terms as question and answer."""

    number: int
    terms: list[str]
    question: list[str]
    answer: list[str]


def make_item(number: int, text: str | None) -> Item:
    sentences = [terms for terms in map(terms_of, SENTENCE.split(text or "")) if terms]
    question = [term for terms in (sentences[:-1] or sentences) for term in terms]
    return Item(number, terms_of(text), question, sentences[-1] if len(sentences) > 1 else [])


@dataclass
class Shard:
    """Part of the index: block maxima per term, and per block the postings (slot in the block, weight) of each term."""

    items: list[Item]
    vocabulary: dict[str, int]
    maxima: np.ndarray
    postings: list[dict[int, tuple[list[int], list[float]]]] = field(default_factory=list)


def build_shards(items: list[Item], shard_items: int = SHARD_ITEMS, block: int = BLOCK) -> list[Shard]:
    """The index; frequencies and lengths are those of all items."""
    items = sorted((item for item in items if item.terms), key=lambda item: (len(item.terms), item.number))
    total = len(items)
    df = Counter(term for item in items for term in set(item.terms))
    mean = sum(len(item.terms) for item in items) / max(1, total)
    shards = []
    for start in range(0, total, shard_items):
        own = items[start : start + shard_items]
        vocabulary = {term: k for k, term in enumerate(sorted({term for item in own for term in item.terms}))}
        shard = Shard(own, vocabulary, np.zeros((len(vocabulary), -(-len(own) // block)), dtype=np.float32))
        for slot, item in enumerate(own):
            counts = Counter(item.terms)
            norm = K1 * (1 - B + B * len(item.terms) / mean)
            weights = {
                term: math.log(1 + (total - df[term] + 0.5) / (df[term] + 0.5)) * count * (K1 + 1) / (count + norm)
                for term, count in counts.items()
            }
            whole = sum(weights.values())
            at, place = divmod(slot, block)
            if not place:
                shard.postings.append({})
            for term, weight in weights.items():
                number, share = vocabulary[term], weight / whole
                shard.maxima[number, at] = max(shard.maxima[number, at], share)
                slots, shares = shard.postings[at].setdefault(number, ([], []))
                slots.append(place)
                shares.append(share)
        shards.append(shard)
    return shards


def wand(lists: list[tuple[list[int], list[float]]], threshold: float) -> list[tuple[int, float]]:
    """(slot, score) of everything that scores at least the threshold, over postings lists sorted by slot."""
    cursors = [[slots[0], 0, slots, shares, max(shares)] for slots, shares in lists]
    found = []
    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, None
        for cursor in cursors:
            bound += cursor[4]
            if bound >= threshold - 1e-6:
                pivot = cursor[0]
                break
        if pivot is None:
            break
        if cursors[0][0] == pivot:
            score = sum(c[3][c[1]] for c in cursors if c[0] == pivot)
            if score >= threshold:
                found.append((pivot, score))
            target = pivot + 1
        else:
            target = pivot
        for cursor in cursors:
            if cursor[0] < target:
                cursor[1] = bisect_left(cursor[2], target, cursor[1])
                cursor[0] = cursor[2][cursor[1]] if cursor[1] < len(cursor[2]) else -1
        cursors = [c for c in cursors if c[0] >= 0]
    return found


class Words(dict):
    """word -> number of its term in a shard's vocabulary, OTHER, or NOTHING; remembered up to a bound."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        term = term_of(word)
        number = self.vocabulary.get(term, OTHER) if term else NOTHING
        if len(self) >= MAX_REMEMBERED:
            self.clear()
        self[word] = number
        return number


class Search:
    """All passages of texts against the shards of one scan."""

    def __init__(self, shards: list[Shard], longest: int, threshold: float, overlap: float):
        self.shards = [(shard, Words(shard.vocabulary)) for shard in shards]
        self.longest, self.threshold, self.overlap = longest, threshold, overlap

    def run(self, texts: list[str | None]) -> list[dict[int, tuple[float, float, float, int]]]:
        """Per text: {item number: (score, question overlap, answer overlap, first word of the passage)}, each for the
        passage that covers the item best."""
        found: list[dict[int, tuple[float, float, float, int]]] = [{} for _ in texts]
        split = [(text or "").lower().split() for text in texts]
        for shard, words in self.shards:
            self.search(shard, words, split, found)
        return found

    def search(self, shard: Shard, words: Words, split: list[list[str]], found: list[dict]) -> None:
        numbers: list[int] = []
        starts: list[int] = []
        passages: list[tuple[int, int]] = []
        step = self.longest
        for k, text in enumerate(split):
            of = [n for n in map(words.__getitem__, text) if n != NOTHING]
            for start in range(0, max(1, len(of) - step), step):
                known = set(of[start : start + 2 * step])
                known.discard(OTHER)
                if known:
                    passages.append((k, start))
                    starts.append(len(numbers))
                    numbers.extend(known)
                if len(passages) == PASSAGES_AT_ONCE:
                    self.retrieve(shard, split, passages, starts, numbers, found)
                    passages, starts, numbers = [], [], []
        if passages:
            self.retrieve(shard, split, passages, starts, numbers, found)

    def retrieve(self, shard: Shard, split: list, passages: list, starts: list[int], numbers: list[int], found: list[dict]) -> None:
        bounds = np.add.reduceat(shard.maxima[np.array(numbers)], np.array(starts), axis=0)
        ends = [*starts[1:], len(numbers)]
        for at, block in np.argwhere(bounds >= self.threshold - 1e-4).tolist():
            postings = shard.postings[block]
            lists = [postings[n] for n in numbers[starts[at] : ends[at]] if n in postings]
            text, start = passages[at]
            for place, score in wand(lists, self.threshold):
                item = shard.items[block * BLOCK + place]
                passage = [term for term in map(term_of, split[text]) if term][start : start + 2 * self.longest]
                asked, answered = coverage(item.question, passage), coverage(item.answer, passage)
                best = found[text].get(item.number)
                if min(asked, answered) >= self.overlap and (best is None or best[0] < score):
                    found[text][item.number] = (score, asked, answered, start)


def scans(shards: list[Shard], cells: int = CELLS_PER_SCAN) -> list[list[Shard]]:
    """Shards in groups whose block maxima have at most so many cells, one shard at least."""
    groups: list[list[Shard]] = []
    held = 0
    for shard in shards:
        if not groups or held + shard.maxima.size > cells:
            groups.append([])
            held = 0
        groups[-1].append(shard)
        held += shard.maxima.size
    return groups


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap, start)``: every verified pair of document and item.

    ``doc_id`` and ``item_id`` have the names of the id columns; ``start`` is the passage's first word.
    """
    spark = tuned_batches(docs.sparkSession)
    named = items.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text")).orderBy("id", "text")
    ids, made = [], []
    for row in named.toLocalIterator():
        made.append(make_item(len(ids), row["text"]))
        ids.append(row["id"])
    kinds = [df.select(F.col(c)).schema[0].dataType.simpleString() for df, c in ((docs, id_col), (items, item_col))]
    outputs = f"_doc {kinds[0]}, _item long, score double, question_overlap double, answer_overlap double, start long"
    longest = max((len(item.terms) for item in made), default=1)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = []
    for group in scans(build_shards(made)):
        shared = spark.sparkContext.broadcast(group)  # at most CELLS_PER_SCAN cells, or one shard

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = Search(shared.value, longest, threshold, overlap)
            for batch in batches:
                hits = search.run(batch.column(1).to_pylist())
                taken = [k for k, of in enumerate(hits) for _ in of]
                flat = [(number, *values) for of in hits for number, values in of.items()]
                columns = list(zip(*flat)) if flat else [[]] * 5
                types = (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
                arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
                first = batch.column(0).take(pa.array(taken, pa.int64()))
                names = ["_doc", "_item", "score", "question_overlap", "answer_overlap", "start"]
                yield pa.RecordBatch.from_arrays([first, *arrays], names)

        parts.append(rows.mapInArrow(run, outputs))
    if not parts:
        parts = [rows.filter("false").selectExpr("id AS _doc", "0L AS _item", "0D AS score", "0D AS question_overlap", "0D AS answer_overlap", "0L AS start")]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    names = spark.createDataFrame(list(enumerate(ids)), f"_item long, _id {kinds[1]}")
    return found.join(names, "_item").select(
        F.col("_doc").alias(id_col), F.col("_id").alias(item_col), "score", "question_overlap", "answer_overlap", "start"
    )


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a verified test item."""
    leaks = checkpointed(contaminated(docs, items, id_col, text_col).select(id_col).distinct())
    return docs.join(small(leaks, leaks.count()), id_col, "left_anti")
