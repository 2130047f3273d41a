"""Language ID by a string kernel: blended-spectrum presence kernels, Nyström landmarks, kernel ridge regression.

The kernel of two texts is the number of distinct character n-grams (of lengths ``SIZES``, in lower-cased text) that
both have, divided by the geometric mean of their own numbers. Landmarks are texts of the training sample, balanced over
languages; a text's kernel values against them, whitened by the landmarks' own kernel matrix, are its features; and one
ridge regression per language against the rest (targets 1 and 0) gives its scores. A batch of texts is scored by
products of its presence matrix with the landmarks' and of the kernel values with the folded weights.

The fit takes a bounded sample: of each language at most ``ROWS_PER_LANGUAGE`` training rows with at most
``SAMPLE_CHARS`` characters, the first by a hash of the id, of the ``LANGUAGES`` most frequent languages. Every text is
predicted whole.

Cases: a text that is NULL or has no letter is ``und`` with score 0, and so is every text if there is nothing to learn
from; rows with a NULL language are not learned from; repeated rows are predicted each; an empty table gives an empty
table; further columns are kept, and a column that clashes with an output raises ValueError; ties go to the language
that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import no_clash, tuned_batches

SIZES = (1, 2, 3)
ROWS_PER_LANGUAGE = 200
LANDMARKS_PER_LANGUAGE = 24
LANGUAGES = 256
SAMPLE_CHARS = 6_000
RIDGE = 0.05
# Cells of the presence matrix of a batch, in float32.
CELLS = 1 << 22
UNKNOWN = "und"
OUTPUTS = ("lang_pred", "score")


def grams(text: str) -> np.ndarray:
    """Sorted distinct n-grams of a text, each as a 64-bit number of its characters (21 bits a character)."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) + 1
    found, run = [], codes
    for size in range(1, max(SIZES) + 1):
        if size > 1:
            run = (run[:-1] << 21) | codes[size - 1 :]
        if size in SIZES and len(run):
            ordered = np.sort(run)
            found.append(ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])])
    return np.concatenate(found) if found else codes


@dataclass
class KernelModel:
    """Landmarks as presence over their n-grams, and the folded weights from kernel values to languages."""

    languages: list[str]
    vocabulary: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def kernel(self, rows: list[np.ndarray]) -> np.ndarray:
        """Kernel values of texts, as arrays of n-grams, against the landmarks."""
        presence = np.zeros((len(rows), len(self.vocabulary)), dtype=np.float32)
        sizes = np.array([max(1, len(row)) for row in rows], dtype=np.float32)
        for k, row in enumerate(rows):
            at = np.searchsorted(self.vocabulary, row)
            at[at == len(self.vocabulary)] = 0
            presence[k, at[self.vocabulary[at] == row]] = 1.0
        return (presence @ self.landmarks) / np.sqrt(sizes)[:, None]

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """One score per text and language, about 1 for the language of the text and 0 for the others."""
        step = max(1, CELLS // max(1, len(self.vocabulary)))
        parts = [self.kernel(rows[k : k + step]) @ self.weights for k in range(0, len(rows), step)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))


def fit_kernel(texts: list[str], langs: list[str], landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> KernelModel:
    """The model of a sample; the first ``landmarks`` texts of each language are its landmarks."""
    languages = sorted(set(langs))
    rows = [grams(text) for text in texts]
    taken: dict[str, int] = dict.fromkeys(languages, 0)
    chosen = []
    for k, lang in enumerate(langs):
        if taken[lang] < landmarks:
            taken[lang] += 1
            chosen.append(k)
    vocabulary = np.unique(np.concatenate([rows[k] for k in chosen]))
    presence = np.zeros((len(vocabulary), len(chosen)), dtype=np.float32)
    for column, k in enumerate(chosen):
        presence[np.searchsorted(vocabulary, rows[k]), column] = 1.0 / np.sqrt(max(1, len(rows[k])))
    model = KernelModel(languages, vocabulary, presence, np.zeros((0, 0)))
    values = np.concatenate([model.kernel(rows[k : k + 64]) for k in range(0, len(rows), 64)]).astype(np.float64)
    own = values[chosen]
    lengths, vectors = np.linalg.eigh((own + own.T) / 2)
    kept = lengths > 1e-6 * lengths.max()
    whiten = vectors[:, kept] / np.sqrt(lengths[kept])
    features = values @ whiten
    targets = np.array([[lang == name for name in languages] for lang in langs], dtype=np.float64)
    # Every language weighs the same, however many rows it has.
    weight = 1.0 / targets.sum(axis=0)[targets.argmax(axis=1)]
    gram = (features * weight[:, None]).T @ features + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, (features * weight[:, None]).T @ targets)
    model.weights = (whiten @ solved).astype(np.float32)
    return model


def fit(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    sample_chars: int = SAMPLE_CHARS,
) -> KernelModel | None:
    """The model of the rows where ``training`` is true; None if there are none with a language and a letter."""
    known = docs.filter(training & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    usable = known.filter(F.col("text").rlike(r"\p{L}") & (F.length("text") <= sample_chars))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    # Twice the rows wanted of every language by a threshold on the hash, then the first of them: no language's rows meet
    # in one task, and a few hundred short rows of each come to the driver.
    share = F.create_map(*[F.lit(x) for r in counts for x in (r[0], min(1.0, 2.0 * rows_per_language / r[1] + 16.0 / r[1]))])
    mixed = F.xxhash64("id", "lang")
    picked = usable.select("text", "lang", mixed.alias("mixed")).filter(
        F.pmod("mixed", F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20)
    )
    rows = sorted((r["lang"], r["mixed"], r["text"]) for r in picked.collect())
    kept: dict[str, list[str]] = {}
    for lang, _, text in rows:
        if len(of := kept.setdefault(lang, [])) < rows_per_language:
            of.append(text)
    if not kept:
        return None
    return fit_kernel([t for of in kept.values() for t in of], [lang for lang, of in kept.items() for _ in of])


def predict(docs: DataFrame, model: KernelModel | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1)."""
    no_clash(docs, OUTPUTS)
    tuned_batches(docs.sparkSession)
    if model is None:
        return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample: landmarks of at most SAMPLE_CHARS

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            whole = [text or "" for text in texts]
            scores = known.scores([grams(text) for text in whole])
            best = scores.argmax(axis=1) if len(whole) else np.zeros(0, dtype=int)
            lettered = np.array([any(map(str.isalpha, text)) for text in whole], dtype=bool)
            langs = [known.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered)]
            values = np.clip(scores[np.arange(len(whole)), best], 0.0, 1.0) if len(whole) else np.zeros(0)
            yield pd.DataFrame({"lang_pred": langs, "score": np.where(lettered, values, 0.0)}).astype({"lang_pred": object, "score": float})

    result = "_".join(["judged", *docs.columns])  # no column has this name
    judged = docs.select("*", judge(F.col(f"`{text_col}`")).alias(result))
    return judged.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"`{result}`")[name].alias(name) for name in ("lang_pred", "score")])
