"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF that adds what they miss.

The tagger is trained in numpy from labelled spans: those that the patterns find in a bounded sample of texts (at most
``SAMPLE_ROWS`` of at most ``SAMPLE_CHARS`` characters, the first by a hash of the id), and generated ones in other
spellings (phones without a plus, ``name (at) host``, grouped cards) beside generated numbers and keys that are nothing.
Texts are read in half-overlapping windows wherever a character stands without which no span can be (a digit, ``@``,
``(at)``), and every position takes its tag from the window in which it lies farthest from an edge, so windows are
reconciled over the whole text and not one by one. A tagged span is added if it has the form of its kind and touches no
pattern's span.

Cases: a NULL or empty text has no span; repeated rows are searched each; an empty table gives an empty table; further
columns are kept, and a column that clashes with an output raises ValueError; long texts take time in proportion to
their length, as no pattern looks at a character more than a few times.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import checkpointed, no_clash, tuned_batches

# Kinds in the order in which ties of spans are listed, and the patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can begin only where a run of digits does, and takes whole runs.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")

SAMPLE_ROWS = 600
SAMPLE_CHARS = 20_000
WINDOW, STRIDE = 96, 48
EMBEDDING, HIDDEN = 12, 20
WINDOWS_AT_ONCE = 512
TRAINING_WINDOWS = 1_600
EPOCHS, BATCH, RATE = 8, 64, 0.02
TAGS = 1 + 2 * len(KINDS)
ALPHABET = {chr(c): c - 30 for c in range(32, 127)}
LETTER, OTHER, NEWLINE, PAD = 97, 98, 99, 0
OUTPUTS = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added")

Span = tuple[int, int, str]


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    doubled = [2 * int(c) - 9 * (c > "4") for c in digits[-2::-2]]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, from each ``@`` backwards over its local part, so that no run is read twice."""
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by start and kind; matches that fail their kind's check are dropped."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, b, "email") for a, b in emails(text)]
    if re.search("[0-9]", text):
        found += [(*m.span(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if 14 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
                found.append((*m.span(), "card"))
        found += [(*m.span(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def listed(spans: list[Span]) -> str:
    """``kind:start:end`` of all spans, by start and kind, comma-joined."""
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]))))


def plausible(text: str, kind: str) -> bool:
    """Whether a tagged span has the form of its kind."""
    digits = digits_of(text)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s?(?:@|[(\[]at[)\]])\s?[A-Za-z0-9-]+(?:(?:\.|\s?[(\[]dot[)\]]\s?)[A-Za-z0-9-]+)+", text))
    if kind == "ip":
        return bool(re.fullmatch(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}", text)) and all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"[0-9][0-9 .-]+[0-9]", text))
    return 9 <= len(digits) <= 15 and bool(re.fullmatch(r"[(+]?[0-9][0-9 ().-]+[0-9]", text)) and bool(re.search(r"[ ().-]", text))


def encode(text: str) -> np.ndarray:
    """Characters as numbers: printable ASCII each, other letters, line ends, the rest."""
    known = ALPHABET
    return np.array([known.get(c) or (NEWLINE if c == "\n" else LETTER if c.isalpha() else OTHER) for c in text], dtype=np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray, keep: bool = False):
    """Hidden states (T, B, H) for inputs (T, B, D), and what the backward pass needs."""
    steps, size, hidden = x.shape[0], x.shape[1], u.shape[0]
    inputs = x @ w + b
    h, c = np.zeros((size, hidden), dtype=x.dtype), np.zeros((size, hidden), dtype=x.dtype)
    out, cache = np.empty((steps, size, hidden), dtype=x.dtype), []
    for t in range(steps):
        gates = inputs[t] + h @ u
        ifo = sigmoid(gates[:, : 3 * hidden])
        i, f, o = ifo[:, :hidden], ifo[:, hidden : 2 * hidden], ifo[:, 2 * hidden :]
        g = np.tanh(gates[:, 3 * hidden :])
        before, last = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        out[t] = h
        if keep:
            cache.append((i, f, o, g, before, squashed, last))
    return out, cache


def lstm_gradient(x, w, u, cache, d_out):
    """Gradients of (x, w, u, b) by backpropagation through time."""
    d_x, d_w, d_u, d_b = np.zeros_like(x), np.zeros_like(w), np.zeros_like(u), np.zeros(w.shape[1], dtype=x.dtype)
    d_h = d_c = 0.0
    for t in range(x.shape[0] - 1, -1, -1):
        i, f, o, g, before, squashed, last = cache[t]
        total = d_out[t] + d_h
        d_c = d_c + total * o * (1 - squashed**2)
        d_gates = np.concatenate(
            [d_c * g * i * (1 - i), d_c * before * f * (1 - f), total * squashed * o * (1 - o), d_c * i * (1 - g**2)], axis=1
        )
        d_c = d_c * f
        d_h = d_gates @ u.T
        d_x[t] = d_gates @ w.T
        d_w += x[t].T @ d_gates
        d_u += last.T @ d_gates
        d_b += d_gates.sum(axis=0)
    return d_x, d_w, d_u, d_b


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Parameters by name: embedding, both LSTMs, projection to tags, CRF transitions."""

    p: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)

        def made(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        p = {"embed": rng.normal(0, 0.5, (PAD + 100, EMBEDDING)).astype(np.float32)}
        for way in ("f", "b"):
            p |= {f"w{way}": made(EMBEDDING, 4 * HIDDEN), f"u{way}": made(HIDDEN, 4 * HIDDEN), f"c{way}": np.zeros(4 * HIDDEN, np.float32)}
            p[f"c{way}"][HIDDEN : 2 * HIDDEN] = 1.0
        p |= {"out": made(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "moves": np.zeros((TAGS, TAGS), np.float32)}
        return cls(p)

    def emissions(self, ids: np.ndarray, keep: bool = False):
        """Tag scores (T, B, tags) of windows (B, T)."""
        p, x = self.p, self.p["embed"][ids.T]
        ahead, first = lstm(x, p["wf"], p["uf"], p["cf"], keep)
        back, second = lstm(x[::-1], p["wb"], p["ub"], p["cb"], keep)
        both = np.concatenate([ahead, back[::-1]], axis=2)
        return both @ p["out"] + p["bias"], (x, both, first, second)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Best tag sequences (B, T) under the CRF."""
        scores, _ = self.emissions(ids)
        moves, best, came = self.p["moves"], scores[0], []
        for t in range(1, len(scores)):
            ways = best[:, :, None] + moves
            came.append(ways.argmax(axis=1))
            best = ways.max(axis=1) + scores[t]
        tags = np.empty((len(scores), ids.shape[0]), dtype=np.int8)
        tags[-1] = best.argmax(axis=1)
        rows = np.arange(ids.shape[0])
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = came[t - 1][rows, tags[t]]
        return tags.T

    def gradient(self, ids: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean negative log-likelihood of tag sequences (B, T)."""
        p = self.p
        scores, (x, both, first, second) = self.emissions(ids, keep=True)
        steps, size = scores.shape[:2]
        tags, moves, rows = tags.T, p["moves"], np.arange(size)
        ahead, after = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, steps):
            ahead[t] = log_sum(ahead[t - 1][:, :, None] + moves, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            after[t] = log_sum(moves + (scores[t + 1] + after[t + 1])[:, None, :], 2)
        total = log_sum(ahead[-1], 1)
        d_scores = np.exp(ahead + after - total[None, :, None])
        d_moves = np.zeros_like(moves)
        for t in range(1, steps):
            d_moves += np.exp(
                ahead[t - 1][:, :, None] + moves + (scores[t] + after[t])[:, None, :] - total[:, None, None]
            ).sum(axis=0)
            np.subtract.at(d_moves, (tags[t - 1], tags[t]), 1.0)
            d_scores[t, rows, tags[t]] -= 1.0
        d_scores[0, rows, tags[0]] -= 1.0
        d_scores /= size
        d_both = d_scores @ p["out"].T
        d_x, d_wf, d_uf, d_cf = lstm_gradient(x, p["wf"], p["uf"], first, d_both[:, :, :HIDDEN])
        d_back, d_wb, d_ub, d_cb = lstm_gradient(x[::-1], p["wb"], p["ub"], second, d_both[::-1, :, HIDDEN:])
        d_embed = np.zeros_like(p["embed"])
        np.add.at(d_embed, ids.T, d_x + d_back[::-1])
        flat = both.reshape(-1, both.shape[2])
        return {
            "embed": d_embed, "wf": d_wf, "uf": d_uf, "cf": d_cf, "wb": d_wb, "ub": d_ub, "cb": d_cb,
            "out": flat.T @ d_scores.reshape(-1, TAGS), "bias": d_scores.sum(axis=(0, 1)), "moves": d_moves / size,
        }


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    """Begin and inside tags per character."""
    tags = np.zeros(length, dtype=np.int64)
    for a, b, kind in spans:
        k = KINDS.index(kind)
        tags[a:b] = 2 + 2 * k
        if a >= 0:
            tags[a] = 1 + 2 * k
    return tags


def generated(rng: random.Random) -> tuple[str, str | None]:
    """A string and its kind, or None for one that is nothing."""
    letters, number = "abcdefghijklmnopqrstuvwxyz", lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice(letters) for _ in range(rng.randint(3, 9)))
    choice = rng.randrange(12)
    if choice < 3:
        name = word() + rng.choice(["", ".", "_", "-"]) + rng.choice([word(), number(2)])
        host = ".".join([word() + rng.choice(["", number(1)]) for _ in range(rng.randint(1, 2))] + [rng.choice(["com", "org", "net", "de", "io"])])
        at = rng.choice(["@", " (at) ", " [at] "])
        return name + at + (host if at == "@" or rng.random() < 0.5 else host.replace(".", " (dot) ")), "email"
    if choice < 5:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4)), "ip"
    if choice < 7:
        body = number(15)
        digits = next(body + c for c in "0123456789" if luhn(body + c))
        joint = rng.choice(["", " ", "-", "."])
        return joint.join(digits[i : i + 4] for i in range(0, 16, 4)), "card"
    if choice < 9:
        area, first, last = number(3), number(3), number(4)
        return rng.choice(["+{n} ({a}) {b}-{c}", "({a}) {b}-{c}", "{a}-{b}-{c}", "+{n}{a}{b}{c}", "0{a} {b} {c}", "+{n} {a} {b} {c}"]).format(
            n=number(rng.randint(1, 2)).lstrip("0") or "1", a=area, b=first, c=last
        ), "phone"
    kind = rng.randrange(5)
    if kind == 0:
        return "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([18, 32, 40]))), None
    if kind == 1:
        return "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), None
    if kind == 2:
        return f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", None
    if kind == 3:
        return str(rng.randint(1, 2030)), None
    return f"{number(2)}-{number(2)}-{rng.randint(1990, 2030)}", None


def training_windows(texts: list[str], rng: random.Random, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags (count, WINDOW): half around labelled spans of the texts, the rest with generated strings."""
    found = [(text, span) for text in texts for span in base_spans(text)]
    plain = [text for text in texts if text] or ["and the of"]
    ids, tags = np.zeros((count, WINDOW), dtype=np.int64), np.zeros((count, WINDOW), dtype=np.int64)
    for k in range(count):
        if found and k % 2:
            text, (a, b, _) = found[rng.randrange(len(found))]
            start = max(0, rng.randint(b - WINDOW, a) if b - a < WINDOW else a)
            labels = tags_of(len(text), base_spans(text))
        else:
            text = plain[rng.randrange(len(plain))]
            cut = text.find(" ", rng.randrange(len(text)))
            cut = len(text) if cut < 0 else cut
            string, kind = generated(rng)
            known = base_spans(text)
            left, right = text[max(0, cut - WINDOW) : cut], text[cut : cut + WINDOW]
            moved = [(x - cut + len(left), y - cut + len(left), s) for x, y, s in known if y <= cut and x >= cut - len(left)]
            moved += [(x - cut + len(left) + 1 + len(string), y - cut + len(left) + 1 + len(string), s) for x, y, s in known if x >= cut and y <= cut + len(right)]
            own = len(left) + 1
            text = f"{left} {string}{right}"
            labels = tags_of(len(text), moved + ([(own, own + len(string), kind)] if kind else []))
            start = max(0, min(own, own + rng.randint(-WINDOW + 20, 0)))
        part = encode(text[start : start + WINDOW])
        ids[k, : len(part)] = part
        tags[k, : len(part)] = labels[start : start + WINDOW]
    return ids, tags


def train(texts: list[str], seed: int = 7, count: int = TRAINING_WINDOWS, epochs: int = EPOCHS) -> Tagger:
    """A tagger from sampled texts, by Adam; the same texts give the same tagger."""
    model, rng = Tagger.fresh(seed), random.Random(seed)
    ids, tags = training_windows(texts, rng, count)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    step, total = 0, epochs * -(-count // BATCH)
    for _ in range(epochs):
        order = np.array(rng.sample(range(count), count))
        for start in range(0, count, BATCH):
            step += 1
            some = order[start : start + BATCH]
            rate = RATE * (1 - step / (total + 1))
            for name, g in model.gradient(ids[some], tags[some]).items():
                g = np.clip(g, -1.0, 1.0)
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                m, v = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
                model.p[name] = (model.p[name] - rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return model


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a character without which no span can be."""
    numbers: set[int] = set()
    for match in TRIGGER.finditer(text):
        k = match.start() // STRIDE
        numbers.add(k)
        if k:
            numbers.add(k - 1)
    return [k * STRIDE for k in sorted(numbers)]


def reconciled(windows: list[tuple[int, np.ndarray]]) -> list[Span]:
    """Spans from the tags of a text's windows, in order: each position has the tag of the window in whose middle it lies
    most."""
    spans: list[Span] = []
    depth = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]).astype(np.int16)
    k = 0
    while k < len(windows):
        last = k
        while last + 1 < len(windows) and windows[last + 1][0] < windows[last][0] + WINDOW:
            last += 1
        origin = windows[k][0]
        tags = np.zeros(windows[last][0] + WINDOW - origin, dtype=np.int8)
        deep = np.full(len(tags), -1, dtype=np.int16)
        for start, own in windows[k : last + 1]:
            place = slice(start - origin, start - origin + WINDOW)
            better = depth > deep[place]
            tags[place] = np.where(better, own, tags[place])
            deep[place] = np.where(better, depth, deep[place])
        open_at = ended = kind = -1
        for at in [*np.flatnonzero(tags).tolist(), len(tags) + 1]:
            tag = int(tags[at]) if at < len(tags) else 0
            begins = tag % 2 == 1 or kind != (tag - 1) // 2 or at != ended
            if open_at >= 0 and begins:
                spans.append((origin + open_at, origin + ended, KINDS[kind]))
                open_at = -1
            if tag and begins:
                open_at, kind = at, (tag - 1) // 2
            ended = at + 1
        k = last + 1
    return spans


def added_spans(texts: list[str], base: list[list[Span]], model: Tagger) -> list[list[Span]]:
    """Per text, the tagged spans that have the form of their kind and touch no span of a pattern."""
    places = [(k, start) for k, text in enumerate(texts) for start in window_starts(text)]
    tagged: list[list[tuple[int, np.ndarray]]] = [[] for _ in texts]
    for first in range(0, len(places), WINDOWS_AT_ONCE):
        some = places[first : first + WINDOWS_AT_ONCE]
        ids = np.zeros((len(some), WINDOW), dtype=np.int64)
        for row, (k, start) in enumerate(some):
            part = encode(texts[k][start : start + WINDOW])
            ids[row, : len(part)] = part
        for (k, start), tags in zip(some, model.decode(ids)):
            tagged[k].append((start, tags))
    added: list[list[Span]] = []
    for text, own, windows in zip(texts, base, tagged):
        new = []
        for a, b, kind in reconciled(windows) if windows else []:
            b = min(b, len(text))
            if a < b and plausible(text[a:b], kind) and all(b <= x or y <= a for x, y, _ in own):
                new.append((a, b, kind))
        added.append(new)
    return added


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Tagger:
    """The tagger of a table's sample; with nothing to sample, of generated strings alone."""
    usable = docs.select(F.xxhash64(F.col(id_col)).alias("h"), F.col(text_col).alias("text")).filter(
        (F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]")
    )
    keyed = usable.select("h", F.xxhash64("text").alias("t"), "text")
    # Rows are chosen by two numbers each; only the texts of those chosen are fetched, one of equal ones.
    chosen = checkpointed(keyed.select("h", "t").orderBy("h", "t").limit(rows)).distinct()
    texts = keyed.join(F.broadcast(chosen), ["h", "t"]).groupBy("h", "t").agg(F.min("text").alias("text"))
    sample = texts.collect()  # at most rows x SAMPLE_CHARS
    return train([row["text"] for row in sorted(sample, key=lambda r: (r["h"], r["t"]))])


def find(docs: DataFrame, model: Tagger, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of pattern spans per kind, ``base_sha256`` (of their list), ``spans`` (the list of all
    spans) and ``n_added`` (how many of them the tagger added)."""
    no_clash(docs, OUTPUTS)
    tuned_batches(docs.sparkSession)
    params = model.p  # about 12,000 numbers

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(params)
        for batch in batches:
            texts = [text or "" for text in batch]
            base = [base_spans(text) for text in texts]
            added = added_spans(texts, base, tagger)
            counts = {f"n_{kind}": [sum(s[2] == kind for s in own) for own in base] for kind in KINDS}
            yield pd.DataFrame(
                counts
                | {
                    "base_sha256": [hashlib.sha256(listed(own).encode()).hexdigest() for own in base],
                    "spans": [listed(own + new) for own, new in zip(base, added)],
                    "n_added": [len(new) for new in added],
                }
            )

    result = "_".join(["found", *docs.columns])  # no column has this name
    found = docs.select("*", search(F.col(f"`{text_col}`")).alias(result))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], *[F.col(f"`{result}`")[name].alias(name) for name in OUTPUTS])
