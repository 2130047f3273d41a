"""Toxicity: severity grades by cumulative-link ordinal regression on sparse text features.

Features are the presence of character n-grams of words, chosen by their association with toxic rows of a bounded,
labelled sample. One weight vector is shared by all thresholds: P(grade <= k) = sigmoid(threshold_k - w.x). The score is
the expected grade; a text is toxic where P(grade >= 1) is at least one half.

The fit takes at most ``rows_per_grade`` labelled rows of each given grade, the first by a hash of the id; everything
else looks at all rows. Labels that only say toxic or not (0 and 1) are refined into three grades: toxic rows with more
than the median number of toxic features are severe (2), the others mild (1). Such grades follow from the features that
predict them; labels that have grades already are taken as they are.

Cases: a NULL or empty text has no feature and the severity of that; labels that are NULL are left out, of repeated
labels of an id the highest counts; without labels of both kinds all severities are 0; repeated rows are scored each; an
empty table gives an empty table; further columns are kept, and a column that clashes with an output raises ValueError.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import discard, no_clash, stored, tuned_batches

ROWS_PER_GRADE = 4_000
FEATURES = 1_024
SIZES = (4, 5)
PENALTY = 1e-3
STEPS = 400
MAX_REMEMBERED = 1 << 18
OUTPUTS = ("severity", "p_toxic", "toxic")


def ngrams(word: str) -> set[str]:
    """Character n-grams of a word between marks of its ends; a shorter word is one n-gram."""
    marked = f"^{word.strip(string.punctuation)}$"
    return {marked[i : i + n] for n in SIZES for i in range(max(1, len(marked) - n + 1))}


class Features(dict):
    """word -> numbers of the chosen n-grams in it, remembered up to a bound."""

    def __init__(self, chosen: dict[str, int]):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: str) -> tuple[int, ...]:
        chosen = self.chosen
        found = tuple(chosen[gram] for gram in ngrams(word) if gram in chosen)
        if len(self) >= MAX_REMEMBERED:
            self.clear()
        self[word] = found
        return found

    def of(self, text: str | None) -> set[int]:
        """Numbers of the chosen n-grams in a whole text."""
        found: set[int] = set()
        for word in set((text or "").lower().split()):
            if numbers := self[word]:
                found.update(numbers)
        return found


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    """Thresholds in ascending order and the weights that they share, by chosen n-gram."""

    chosen: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def survival(self, sums: np.ndarray) -> np.ndarray:
        """P(grade > k) per row and threshold, from the rows' weighted sums."""
        return sigmoid(sums[:, None] - self.thresholds[None, :])


def fit_ordinal(x: np.ndarray, grades: np.ndarray, penalty: float = PENALTY, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the cumulative-link model, by Adam on the penalised likelihood of all rows."""
    kinds = int(grades.max())
    rates = np.array([np.clip((grades > k).mean(), 1e-3, 1 - 1e-3) for k in range(kinds)])
    start = np.log((1 - rates) / rates)
    # Thresholds as a first one and logarithms of steps, so that they stay in order.
    params = np.concatenate([np.zeros(x.shape[1]), start[:1], np.log(np.maximum(np.diff(start), 0.1))]).astype(np.float64)
    first, second = np.zeros_like(params), np.zeros_like(params)
    size, rows = x.shape[1], np.arange(len(grades))
    for step in range(1, steps + 1):
        weights, free = params[:size], params[size:]
        gaps = np.exp(free[1:])
        thresholds = free[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        below = np.concatenate([np.zeros((len(x), 1)), sigmoid(thresholds - (x @ weights)[:, None]), np.ones((len(x), 1))], axis=1)
        upper, lower = below[rows, grades + 1], below[rows, grades]
        chance = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_sum = d_upper - d_lower
        by_threshold = np.array([d_lower[grades == k + 1].sum() - d_upper[grades == k].sum() for k in range(kinds)]) / len(x)
        tail = np.cumsum(by_threshold[::-1])[::-1]
        gradient = np.concatenate([x.T @ by_sum / len(x) + penalty * weights, tail[:1], tail[1:] * gaps])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        params -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return params[:size], params[size] + np.concatenate([[0.0], np.cumsum(np.exp(params[size + 1 :]))])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows_per_grade: int
) -> DataFrame:
    """``(text, grade)`` of at most ``rows_per_grade`` documents of each grade, the first by a hash of the id."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("grade")).filter("grade >= 0 AND _id IS NOT NULL")
    known = known.groupBy("_id").agg(F.max("grade").alias("grade"))
    grades = [row[0] for row in known.select("grade").distinct().orderBy("grade").limit(17).collect()]
    if len(grades) > 16:
        raise ValueError("more than 16 grades")
    parts = [known.filter(F.col("grade") == g).orderBy(F.xxhash64("_id"), "_id").limit(rows_per_grade) for g in grades]
    if not parts:
        return docs.select(F.col(text_col).alias("text"), F.lit(0).alias("grade")).filter("false")
    picked = parts[0]
    for part in parts[1:]:
        picked = picked.unionByName(part)
    # At most 16 x rows_per_grade rows of two numbers.
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(picked), "_id").select("text", "grade")


def count_ngrams(sample: DataFrame) -> DataFrame:
    """``(gram, toxic, clean)``: in how many sampled texts of either kind an n-gram occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {True: Counter(), False: Counter()}
        for batch in batches:
            for text, grade in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set((text or "").lower().split())
                counts[grade > 0].update(set().union(*map(ngrams, words)))
        grams = list(counts[True].keys() | counts[False].keys())
        for start in range(0, len(grams), 50_000):
            part = grams[start : start + 50_000]
            columns = [[counts[kind][gram] for gram in part] for kind in (True, False)]
            yield pa.RecordBatch.from_arrays([pa.array(part), *map(pa.array, columns)], ["gram", "toxic", "clean"])

    counted = sample.mapInArrow(run, "gram string, toxic long, clean long")
    return counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_features(counts: DataFrame, toxic: int, clean: int, most: int) -> list[str]:
    """The n-grams most associated with toxic texts, by the likelihood ratio of two-by-two counts."""
    both = F.col("toxic") + F.col("clean")
    share = both / (toxic + clean)

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(F.lit(0.0))

    ratio = 2 * (
        part(F.col("toxic"), share * toxic) + part(F.col("clean"), share * clean)
        + part(toxic - F.col("toxic"), (1 - share) * toxic) + part(clean - F.col("clean"), (1 - share) * clean)
    )
    # 15.1: one chance in ten thousand for an n-gram that says nothing.
    scored = counts.select("gram", ratio.alias("ratio")).filter((F.col("ratio") > 15.1) & (F.col("toxic") * clean > F.col("clean") * toxic))
    return [row[0] for row in scored.orderBy(F.desc("ratio"), "gram").limit(most).collect()]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_grade: int = ROWS_PER_GRADE,
    features: int = FEATURES,
) -> OrdinalModel | None:
    """The model; None where the labels are not of both kinds."""
    tuned_batches(docs.sparkSession)
    sample, path = stored(labelled_sample(docs, labels, id_col, text_col, label_col, rows_per_grade), "toxicity-sample")
    try:
        kinds = {row[0]: row[1] for row in sample.groupBy("grade").count().collect()}
        clean = kinds.get(0, 0)
        toxic = sum(kinds.values()) - clean
        if not toxic or not clean:
            return None
        grams = choose_features(count_ngrams(sample), toxic, clean, features)
        if not grams:
            return None
        chosen = {gram: k for k, gram in enumerate(grams)}

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Features(chosen)
            for batch in batches:
                found = [sorted(known.of(text)) for text in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["grade", "found"])

        # At most 16 x rows_per_grade rows; sorted, so that the fit does not depend on the order of partitions.
        table = sorted((r[0], r[1]) for r in sample.mapInArrow(rows, "grade int, found array<int>").collect())
    finally:
        discard(docs.sparkSession, path)
    x = np.zeros((len(table), len(grams)), dtype=np.float32)
    for k, (_, found) in enumerate(table):
        x[k, found] = 1.0
    grades = np.array([grade for grade, _ in table])
    if grades.max() == 1:
        hits = x.sum(axis=1)
        grades = np.where((grades == 1) & (hits > np.median(hits[grades == 1])), 2, grades)
    weights, thresholds = fit_ordinal(x, grades)
    return OrdinalModel(chosen, weights, thresholds)


def score(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``severity`` (the expected grade), ``p_toxic`` (of grade 1 or more) and ``toxic``."""
    no_clash(docs, OUTPUTS)
    tuned_batches(docs.sparkSession)
    if model is None:
        zero = F.lit(0.0)
        return docs.select("*", zero.alias("severity"), zero.alias("p_toxic"), F.lit(False).alias("toxic"))
    chosen, weights, thresholds = model.chosen, model.weights, model.thresholds  # at most FEATURES numbers

    @F.pandas_udf("severity double, p_toxic double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, ordinal = Features(chosen), OrdinalModel(chosen, weights, thresholds)
        for texts in batches:
            sums = np.array([weights[sorted(known.of(text))].sum() for text in texts], dtype=np.float64)
            above = ordinal.survival(sums)
            yield pd.DataFrame({"severity": above.sum(axis=1), "p_toxic": above[:, 0]})

    result = "_".join(["judged", *docs.columns])  # no column has this name
    scored = docs.select("*", judge(F.col(f"`{text_col}`")).alias(result))
    severity, p_toxic = [F.col(f"`{result}`")[name] for name in ("severity", "p_toxic")]
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return scored.select(*kept, severity.alias("severity"), p_toxic.alias("p_toxic"), (p_toxic >= 0.5).alias("toxic"))
