"""Secret scans: fixed patterns, and a battery of randomness tests that adds keys in any encoding.

A candidate is a run of ``LEAST`` or more characters of the alphabets of keys that touches no span of a pattern. Its
encoding is the smallest of ``ENCODINGS`` that has all its characters, its symbols are numbers below the size of that
alphabet, and three tests ask whether they could be drawn evenly and one by one: chi-squared of the counts, runs above
and below the middle, and the correlation of each symbol with the next. Their p values are combined by Fisher's method
into one score, small for random strings.

What a score says depends on the length: the shorter a string, the more an ordinary one looks random. So the scores of
ordinary strings are known by encoding and class of length: they are composed of letters that follow each other as they
do in the words of all texts, counted over the whole table, in the ways in which names, paths and numbers are. A
candidate's p value is the chance that an ordinary string of its length has its encoding and scores as low. Over the
candidates of the table, Benjamini and Hochberg's procedure bounds the share of false discoveries by ``FALSE_SHARE``
within every class; to this end they are counted by class and p value, a small table whatever the size of the corpus.

Cases: a NULL or empty text has no span; repeated rows are searched each, and count each; a table without words takes
letters to be even; an empty table gives an empty table; further columns are kept, and a column that clashes with an
output raises ValueError; long texts take time in proportion to their length.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import no_clash, tuned_batches

# Kinds of patterns in the order in which ties of spans are listed, and the patterns.
KINDS = ("assign", "access", "hex")
NAMES = ("password", "passwd", "secret", "token", "api_?key")


def in_either_case(name: str) -> str:
    """A pattern of a name whose ASCII letters may be capitals; no other letters count as the same."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


ASSIGN = re.compile("(" + "|".join(map(in_either_case, NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED, LEAST_ACCESS = 12, 18

# Alphabets of keys, smallest first; a string has the first that has all its characters. Small letters come before
# capitals, so that the halves of an alphabet with both are about its cases.
DIGITS, SMALL, CAPITALS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {
    "hexadecimal": DIGITS + "abcdef",
    "hexadecimal_capitals": DIGITS + "ABCDEF",
    "base32": CAPITALS + "234567",
    "base36": DIGITS + SMALL,
    "base36_capitals": DIGITS + CAPITALS,
    "base62": SMALL + CAPITALS + DIGITS,
    "base64": SMALL + "+/" + CAPITALS + DIGITS,
    "base64url": SMALL + "-_" + CAPITALS + DIGITS,
}
LEAST = 16
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")
# Ends of the classes of length; the last takes all that is longer.
LENGTHS = (18, 20, 24, 28, 32, 40, 48, 64, 96, 128)
# Ordinary strings of an encoding and class of length, and the words that they are made of.
ORDINARY_STRINGS, WORDS = 300, 4_000
FALSE_SHARE = 0.01
# P values are counted by their logarithm, in steps of a tenth, up to this many.
STEPS = 400
OUTPUTS = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added")
LETTERS = 27  # the end of a word, and a to z

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start and kind; matches that are too short are dropped."""
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def listed(spans: list[Span]) -> str:
    """``kind:start:end`` of all spans, by start, patterns first, comma-joined."""
    order = lambda s: (s[0], KINDS.index(s[2]) if s[2] in KINDS else len(KINDS), s[2])
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=order))


# -- the battery -------------------------------------------------------------------------------------------------------

MEMBERS = {name: frozenset(letters) for name, letters in ENCODINGS.items()}
VALUES = {name: {c: i for i, c in enumerate(letters)} for name, letters in ENCODINGS.items()}


def encoding_of(text: str) -> str | None:
    """The smallest alphabet that has all characters of the string."""
    used = set(text)
    return next((name for name, members in MEMBERS.items() if used <= members), None)


def normal_tail(z: float) -> float:
    """The chance of a value above ``z``."""
    return 0.5 * math.erfc(z / math.sqrt(2))


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_tail(x: float, freedom: int) -> float:
    """The chance of a greater chi-squared value, by the cube root that makes it nearly normal."""
    spread = 2 / (9 * freedom)
    return normal_tail(((x / freedom) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def uniformity(values: np.ndarray, size: int) -> float:
    """P value of the counts of symbols, if all are as likely."""
    expected = len(values) / size
    counts = np.bincount(values, minlength=size)
    return chi_squared_tail(float(((counts - expected) ** 2).sum() / expected), size - 1)


def runs(values: np.ndarray, size: int) -> float:
    """P value of the number of runs in the upper and the lower half of the alphabet, if symbols are drawn evenly."""
    upper = values >= size / 2
    share = (size // 2) / size
    change, steps = 2 * share * (1 - share), len(values) - 1
    number = int((upper[1:] != upper[:-1]).sum())
    return two_sided((number - steps * change) / math.sqrt(steps * change * (1 - change)))


def serial_correlation(values: np.ndarray) -> float:
    """P value of the correlation of each symbol with the next, if they are independent."""
    away = values - values.mean()
    square = float((away * away).sum())
    if square == 0:
        return 2.0 ** (1 - len(values))
    n = len(values)
    correlation = float((away[1:] * away[:-1]).sum()) / square
    return two_sided((correlation + 1 / n) * math.sqrt(n))


def battery(text: str, encoding: str) -> float:
    """The cube root of Fisher's combination of the three tests: small for random strings, and nearly normal."""
    known = VALUES[encoding]
    values = np.array([known[c] for c in text])
    size = len(known)
    ps = (uniformity(values, size), runs(values, size), serial_correlation(values))
    return max(0.0, -2 * sum(math.log(max(p, 1e-300)) for p in ps)) ** (1 / 3)


def length_class(length: int) -> int:
    return next((k for k, end in enumerate(LENGTHS) if length <= end), len(LENGTHS))


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int, str, int, float]]:
    """(start, end, encoding, class of length, score) of the runs that touch no span of a pattern."""
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        if any(a < end and start < b for a, b, _ in base):
            continue
        if (encoding := encoding_of(m[0])) is not None:
            yield start, end, encoding, length_class(end - start), battery(m[0], encoding)


# -- ordinary strings --------------------------------------------------------------------------------------------------


def followers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a letter, or the end of a word, follows another, as (pair, n)."""
    table = np.zeros(256, dtype=np.int64)
    for i, c in enumerate(SMALL, 1):
        table[ord(c)] = table[ord(c.upper())] = i
    counts = np.zeros(LETTERS * LETTERS, dtype=np.int64)
    for batch in batches:
        for text in batch.column(0):
            raw = text.as_buffer()
            if raw is not None and raw.size:
                letters = table[np.frombuffer(raw, dtype=np.uint8)]
                pairs = np.concatenate([[0], letters]) * LETTERS + np.concatenate([letters, [0]])
                counts += np.bincount(pairs, minlength=LETTERS * LETTERS)
    yield pa.RecordBatch.from_pydict({"pair": np.arange(len(counts), dtype=np.int32), "n": counts})


def letter_chances(docs: DataFrame, text_col: str) -> np.ndarray:
    """Chances of the next letter or the end of the word, by letter, over all texts."""
    raw = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("raw"))
    rows = raw.mapInArrow(followers, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    counts = np.ones((LETTERS, LETTERS))
    for row in rows:
        counts[row["pair"] // LETTERS, row["pair"] % LETTERS] += row["n"]
    counts[0, 0] = 0  # no empty words
    return counts / counts.sum(axis=1, keepdims=True)


def common_words(rng: random.Random, chances: np.ndarray) -> list[str]:
    """Words whose letters follow each other by chance."""
    ahead, letters, words = np.cumsum(chances, axis=1).tolist(), range(LETTERS), []
    for _ in range(WORDS):
        word, last = "", 0
        while (last := rng.choices(letters, cum_weights=ahead[last])[0]) and len(word) < 16:
            word += SMALL[last - 1]
        words.append(word)
    return words


def ordinary(rng: random.Random, words: list[str], encoding: str | None, length: int) -> str:
    """An ordinary string, as names, paths and numbers are; with an encoding, spelt with its characters."""
    members = MEMBERS[encoding] if encoding else frozenset(SMALL + CAPITALS + DIGITS + "+/-_")
    style = rng.choice((str.lower, str.capitalize, str.upper))
    joint = rng.choice([*(c for c in "-_/+" if c in members), ""])
    # A third of the strings have no number, the others have more or fewer.
    numbers = max(0.0, rng.uniform(-0.25, 0.5)) if members & set(DIGITS) else 0.0
    text = ""
    while len(text) < length:
        if rng.random() < numbers:
            text += str(rng.randrange(*rng.choice(((0, 10), (0, 100), (1900, 2100), (0, 100_000))))) + joint
        else:
            text += style(words[int(rng.random() * len(words))]) + joint
    start = rng.randrange(len(text) - length + 1)
    text = text[start : start + length]
    if not members >= set(SMALL + CAPITALS):
        text = text.upper() if members >= set(CAPITALS[:6]) else text.lower()
    # Where the alphabet lacks a character, one of its own stands in, the same each time.
    own = sorted(members)
    return "".join(c if c in members else own[ord(c) % len(own)] for c in text)


@dataclass
class OrdinaryScores:
    """Ordinary strings by encoding and class of length: their share, and mean and deviation of their scores."""

    moments: dict[tuple[str, int], tuple[float, float, float]]

    def p_value(self, encoding: str, length: int, score: float) -> float:
        """The chance that an ordinary string of the length has the encoding and scores as low."""
        share, mean, deviation = self.moments[encoding, length]
        return share * normal_tail((mean - score) / deviation)


def ordinary_scores(chances: np.ndarray, strings: int = ORDINARY_STRINGS) -> OrdinaryScores:
    """Scores of generated ordinary strings; the same letters give the same scores."""
    rng = random.Random(0)
    words = common_words(rng, chances)
    starts = (LEAST, *(end + 1 for end in LENGTHS))
    moments = {}
    for k, start in enumerate(starts):
        lengths = [rng.randint(start, LENGTHS[k] if k < len(LENGTHS) else 2 * start) for _ in range(strings)]
        kinds = [encoding_of(ordinary(rng, words, None, length)) for length in lengths]
        for encoding in ENCODINGS:
            scores = [battery(ordinary(rng, words, encoding, length), encoding) for length in lengths]
            share = (kinds.count(encoding) + 1) / (strings + 1)
            moments[encoding, k] = share, float(np.mean(scores)), max(float(np.std(scores)), 1e-6)
    return OrdinaryScores(moments)


# -- false discoveries -------------------------------------------------------------------------------------------------


def step_of(p: float) -> int:
    """The place of a p value among the steps: 0 for 1, more for smaller ones."""
    return min(STEPS, int(-10 * math.log10(max(p, 1e-300))))


def discovery_steps(counts: Mapping[tuple[str, int, int], int], share: float = FALSE_SHARE) -> dict[tuple[str, int], int]:
    """Per class the least step from which candidates are discoveries, where there is one.

    ``counts`` are candidates by encoding, class of length and step. A step's p values are taken to be its greatest, so
    the share of false discoveries is bounded as it would be by the values themselves.
    """
    found = {}
    for key in {(encoding, length) for encoding, length, _ in counts}:
        own = {step: n for (*k, step), n in counts.items() if tuple(k) == key}
        total, passed = sum(own.values()), 0
        for step in range(STEPS, -1, -1):
            passed += own.get(step, 0)
            if own.get(step) and 10 ** (-step / 10) <= share * passed / total:
                found[key] = step
    return found


@dataclass
class Scanner:
    """Fitted scores of ordinary strings, and the steps from which candidates are discoveries."""

    scores: OrdinaryScores
    steps: dict[tuple[str, int], int]

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """The candidates of a text that are taken to be secrets."""
        found = []
        for start, end, encoding, length, score in candidates(text, base):
            least = self.steps.get((encoding, length))
            if least is not None and step_of(self.scores.p_value(encoding, length, score)) >= least:
                found.append((start, end, encoding))
        return found


def fit(docs: DataFrame, text_col: str = "text", share: float = FALSE_SHARE) -> Scanner:
    """The scanner of a table; letters and candidates are counted over all its texts."""
    tuned_batches(docs.sparkSession)
    scores = ordinary_scores(letter_chances(docs, text_col))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, _, encoding, length, score in candidates(text, base_spans(text)):
                    key = encoding, length, step_of(scores.p_value(encoding, length, score))
                    counts[key] = counts.get(key, 0) + 1
        columns = list(zip(*counts)) or [(), (), ()]
        arrays = [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts.values(), pa.int64())], ["encoding", "length", "step", "n"])

    # A text without a run of the length has no candidate.
    some = docs.select(F.col(f"`{text_col}`").alias("text")).filter(F.col("text").rlike(f"[A-Za-z0-9+/_-]{{{LEAST}}}"))
    steps = some.mapInArrow(count, "encoding string, length int, step int, n long")
    totals = steps.groupBy("encoding", "length", "step").agg(F.sum("n").alias("n")).collect()  # at most 8 x 11 x 401 rows
    return Scanner(scores, discovery_steps({(r["encoding"], r["length"], r["step"]): r["n"] for r in totals}, share))


def find(docs: DataFrame, scanner: Scanner, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of pattern spans per kind, ``base_sha256`` (of their list), ``spans`` (the list of all
    spans, those that the tests add under the name of their encoding) and ``n_added``."""
    no_clash(docs, OUTPUTS)
    tuned_batches(docs.sparkSession)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [text or "" for text in batch]
            base = [base_spans(text) for text in texts]
            added = [scanner.added(text, own) for text, own in zip(texts, base)]
            counts = {f"n_{kind}": [sum(s[2] == kind for s in own) for own in base] for kind in KINDS}
            rest = {
                "base_sha256": [hashlib.sha256(listed(own).encode()).hexdigest() for own in base],
                "spans": [listed(own + new) for own, new in zip(base, added)],
                "n_added": [len(new) for new in added],
            }
            yield pd.DataFrame(counts | rest)

    result = "_".join(["found", *docs.columns])  # no column has this name
    found = docs.select("*", search(F.col(f"`{text_col}`")).alias(result))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return found.select(*kept, *[F.col(f"`{result}`")[name].alias(name) for name in OUTPUTS])
