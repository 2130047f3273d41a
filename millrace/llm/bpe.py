"""Byte-level BPE by a lazily determinised transducer, and streaming decoding by a UTF-8 state machine.

Encoding. A text is cut into pieces by the vocabulary's pattern; within a piece, the token sequence of BPE is the only
path through the vocabulary on which every adjacent pair is *compatible*: merging the bytes of the pair gives the pair
back. Read as a non-deterministic transducer, a configuration is (token chosen last, node of the vocabulary's trie);
reading a byte moves every configuration down the trie and lets it end a token there. At most as many configurations
live as a token has bytes, and of the tokens that end at one byte only one fits, which is what a step gives out. Sets of
configurations become states of a deterministic machine when they are first reached, and transitions are kept in a table
of bounded size, which is cleared when it is full and filled anew. From the token that ends with the piece, the tokens
before it are read off backwards.

Decoding. Ids are turned into bytes token by token; the state machine tells, over chunks that may end within a
character, where the last whole character ends. Its transitions are composed per token, so only tokens that begin or
end within a character are looked at one by one.

Cases: a NULL text is an empty one (no ids); an empty table gives an empty table; repeated rows are encoded each on their
own; a text of any length is encoded block by block; further columns are passed on by ``encode_documents`` under their
names, and a column that clashes with an output raises a ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 1 << 16
# What a worker remembers: steps of the transducer, strings of either cache, strings' length, pairs of tokens.
MAX_TRANSITIONS = 1 << 18
MAX_REMEMBERED = 1 << 18
LONGEST_REMEMBERED = 64
MAX_PAIRS = 1 << 18


def read_ranks(data: bytes) -> dict[bytes, int]:
    """{token bytes: rank} of a rank file: one base64 token and its rank a line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge by definition: join the adjacent pair of lowest rank, leftmost first, until none is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none, get = len(ranks) << 8, ranks.get
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (lowest := min(pairs)) != none:
        i = pairs.index(lowest)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[part] for part in parts]


class Transducer:
    """Bytes of one piece in, ids out; states and transitions are made when they are first needed.

    A state is what the bytes read leave open: for every start of an unfinished token, from the earliest on, the token
    before it and the node of the trie, as one number each. A step tells the next state and the one token, if any, that ends there
    and fits what is before it; the ids are read off backwards, from the token that ends with the piece. When the table
    is full it is cleared, within a piece too, and filled again from the state at hand.
    """

    ROOT = 0

    def __init__(self, ranks: dict[bytes, int], max_transitions: int = MAX_TRANSITIONS):
        self.ranks = ranks
        # Above every rank: no token, no merge, and what stands before a piece.
        self.none = max(ranks.values(), default=0) + 1
        self.shift = self.none.bit_length()
        self.mask = (1 << self.shift) - 1
        self.max_transitions = max_transitions
        self.tokens = [b""] * self.none
        # The trie: the child of a node by a byte, the token that ends at a node, whether a node has children.
        self.children: dict[int, int] = {}
        self.token_at = [self.none]
        self.inner = bytearray(1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
            node = self.ROOT
            for byte in token:
                edge = node << 8 | byte
                child = self.children.get(edge)
                if child is None:
                    child = self.children[edge] = len(self.token_at)
                    self.inner[node] = 1
                    self.inner.append(0)
                    self.token_at.append(self.none)
                node = child
            self.token_at[node] = rank
        self.sizes = list(map(len, self.tokens))
        self.histories: dict[int, tuple[list[int], list[bytes], list[bytes]] | None] = {}
        self.pairs: dict[int, bool] = {}
        # Steps that were made and not read off the table, and pieces that no path covers.
        self.moved = self.uncovered = 0
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[tuple[int, ...], int] = {}
        self.states: list[tuple[int, ...]] = []
        # Per byte: {state: next state and token}.
        self.table: list[dict[int, int]] = [{} for _ in range(256)]
        self.size = 0
        self.start = self.number((self.ROOT << self.shift | self.none,))

    def number(self, state: tuple[int, ...]) -> int:
        known = self.numbers.get(state)
        if known is None:
            known = self.numbers[state] = len(self.states)
            self.states.append(state)
        return known

    def history(self, token: int) -> tuple[list[int], list[bytes], list[bytes]] | None:
        """How the token's bytes are merged, as far as it changes the parts at its ends.

        (rank of every merge of the last part, those last parts, the rank of every merge of the first, those first parts);
        None if the merges don't give the token.
        """
        if token not in self.histories:
            self.histories[token] = None
            parts, merges = [bytes([b]) for b in self.tokens[token]], []
            ends = [(parts[0], parts[-1])]
            while True:
                pairs = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
                if not pairs:
                    break
                rank, i = min(pairs)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                merges.append(rank)
                ends.append((parts[0], parts[-1]))
            if len(parts) == 1:
                self.histories[token] = (*self.changes(merges, [e[1] for e in ends]), *self.changes(merges, [e[0] for e in ends]))
        return self.histories[token]

    def changes(self, merges: list[int], parts: list[bytes]) -> tuple[list[int], list[bytes]]:
        """The merges that change a part, and the part before, between and after them; no merge comes after the last.

        Where ranks rise, a merge that leaves the part as it is comes before or after one over the border with the same
        result; where they don't, all merges are kept.
        """
        kept = range(len(merges))
        if merges == sorted(merges):
            kept = [i for i in kept if parts[i + 1] != parts[i]]
        return [*[merges[i] for i in kept], self.none], [parts[0], *[parts[i + 1] for i in kept]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: merging the bytes of both gives just these two.

        The merges of both are run side by side, lowest rank first, left before right; a merge of the parts that meet is
        the only one that neither has alone.
        """
        key = left << self.shift | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            before, after = self.history(left), self.history(right)
            known = before is not None and after is not None and not self.crossed(before, after)
            self.pairs[key] = known
        return known

    def crossed(self, before: tuple, after: tuple) -> bool:
        """Whether a merge over the border of two tokens comes before the tokens are whole, or when they are."""
        merges, lasts, _, _ = before
        _, _, others, firsts = after
        none, rank_of = self.none, self.ranks.get
        i = j = 0
        while True:
            across = rank_of(lasts[i] + firsts[j], none)
            own, other = merges[i], others[j]
            if across < own and across <= other:
                return True
            if own <= other:
                if own == none:
                    return False
                i += 1
            else:
                j += 1

    def follows(self, before: int, token: int) -> bool:
        return self.history(token) is not None if before == self.none else self.compatible(before, token)

    def move(self, state: int, byte: int) -> int:
        """Next state and token that ends with one byte, as one number; the table keeps it.

        Starts stand in their order, so the longest token is tried first; of the tokens that end here only one can follow
        what is before it.
        """
        shift, mask, none = self.shift, self.mask, self.none
        children, token_at, inner, pairs = self.children, self.token_at, self.inner, self.pairs
        reached, ended = [], none
        for item in self.states[state]:
            child = children.get(item >> shift << 8 | byte)
            if child is None:
                continue
            last = item & mask
            if inner[child]:
                reached.append(child << shift | last)
            if ended == none:
                token = token_at[child]
                if token != none:
                    fits = pairs.get(last << shift | token)
                    if self.follows(last, token) if fits is None else fits:
                        ended = token
        if ended != none:
            reached.append(self.ROOT << shift | ended)
        step = self.table[byte][state] = self.number(tuple(reached)) << shift | ended
        self.size += 1
        self.moved += 1
        return step

    def forget(self, state: int) -> int:
        """Clear the full table; the machine goes on from the same state and is determinised anew."""
        kept = self.states[state]
        self.clear()
        return self.number(kept)

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece. A piece that is a token as a whole is that token; bytes that no path covers are merged
        by definition."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, ended, table, shift, mask = self.start, [], self.table, self.shift, self.mask
        for byte in piece:
            step = table[byte].get(state)
            if step is None:
                if self.size >= self.max_transitions:
                    state, table = self.forget(state), self.table
                step = self.move(state, byte)
            state = step >> shift
            ended.append(step & mask)
        ids, sizes, at = [], self.sizes, len(ended)
        while at:
            token = ended[at - 1]
            if token == self.none:
                self.uncovered += 1
                return merge(piece, self.ranks)
            ids.append(token)
            at -= sizes[token]
        ids.reverse()
        return ids


class Remembered(dict):
    """string -> ids as packed integers, by ``encode``; short strings are remembered, up to a bound.

    When it is full, what it holds is kept once more beside it, so strings that come often stay.
    """

    def __init__(self, encode: Callable[[str], bytes], most: int = MAX_REMEMBERED):
        super().__init__()
        self.encode, self.most = encode, most
        self.before: dict[str, bytes] = {}

    def __missing__(self, string: str) -> bytes:
        packed = self.before.get(string)
        if packed is None:
            packed = self.encode(string)
        if len(string) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[string] = packed
        return packed


class Encoder:
    """Texts in, ids out, by rank file and pattern."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.ranks = read_ranks(rank_file)
        self.transducer = Transducer(self.ranks)
        self.pieces = regex.compile(pattern).findall
        self.known = Remembered(self.whole)
        self.words = Remembered(self.word)
        # Between a character that is no white space and one that is, every piece ends.
        self.cut = regex.compile(r"\S(?=\s)").search
        self.run_of_spaces = regex.compile(r"\s ").search

    def whole(self, piece: str) -> bytes:
        return struct_ids(self.transducer.encode(piece.encode()))

    def word(self, word: str) -> bytes:
        """A word after a space; where that is one piece, it need not be remembered twice."""
        known, pieces = self.known, self.pieces(" " + word)
        return self.whole(pieces[0]) if len(pieces) == 1 else b"".join([known[piece] for piece in pieces])

    def by_piece(self, text: str) -> bytes:
        known = self.known
        return b"".join([known[piece] for piece in self.pieces(text)])

    def blocks(self, text: str) -> Iterator[str]:
        """The text in parts of about BLOCK_CHARS that are cut only where pieces end."""
        start = 0
        while len(text) - start > BLOCK_CHARS:
            found = self.cut(text, start + BLOCK_CHARS)
            if found is None:
                break
            end = found.start() + 1
            yield text[start:end]
            start = end
        yield text[start:] if start else text

    def pack(self, block: str) -> bytes:
        """Where every space follows a character that is no white space, each space begins a piece: word by word."""
        if self.run_of_spaces(block):
            return self.by_piece(block)
        words = self.words
        first, *rest = block.split(" ")
        return self.by_piece(first) + b"".join([words[word] for word in rest])

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text, without special tokens."""
        packed = [self.pack(block) for block in self.blocks(text)]
        return np.frombuffer(packed[0] if len(packed) == 1 else b"".join(packed), dtype="<u4")


def struct_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


# UTF-8 by state. State 0 is between characters, BAD swallows everything; the others await
# continuation bytes: 1-3 that many of any kind, the rest a first one in a narrower range.
BAD = 8
UTF8_STARTS = [
    (0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2),
    (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7),
]
UTF8_NEXT = {
    1: (0x80, 0xBF, 0), 2: (0x80, 0xBF, 1), 3: (0x80, 0xBF, 2), 4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1),
    6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2),
}


def utf8_table() -> np.ndarray:
    """next state [state, byte] of the UTF-8 machine."""
    table = np.full((9, 256), BAD, dtype=np.uint8)
    for low, high, state in UTF8_STARTS:
        table[0, low : high + 1] = state
    for state, (low, high, after) in UTF8_NEXT.items():
        table[state, low : high + 1] = after
    return table


class Decoder:
    """Ids in, text out, chunk by chunk; ``feed`` keeps back the bytes of an unfinished character."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        bytewise = utf8_table()
        # Per state and token: the state after the token.
        self.after = np.zeros((9, size), dtype=np.uint8)
        for state in range(9):
            row = bytewise.tolist()
            moves = self.after[state]
            for rank, token in enumerate(self.tokens):
                at = state
                for byte in token:
                    at = row[at][byte]
                moves[rank] = at
        self.reset()

    def reset(self) -> None:
        self.state, self.held = 0, b""

    def run(self, ids: np.ndarray) -> tuple[int, int]:
        """(state after the ids, number of leading ids that end between characters), from the present state."""
        steps = self.after[0, ids]
        odd = np.flatnonzero(steps).tolist()
        state, whole, position, k = self.state, 0, 0, 0
        if state == 0:
            whole = odd[0] if odd else len(ids)
            position = whole
        while position < len(ids):
            state = int(self.after[state, ids[position]])
            if state == BAD:
                raise UnicodeDecodeError("utf-8", self.tokens[ids[position]], 0, 1, "ids do not decode to UTF-8")
            position += 1
            if state == 0:
                while k < len(odd) and odd[k] < position:
                    k += 1
                whole = position = odd[k] if k < len(odd) else len(ids)
        return state, whole

    def feed(self, ids: np.ndarray) -> str:
        """The whole characters that the ids complete; raises UnicodeDecodeError at ids that are no UTF-8."""
        state, whole = self.run(ids)
        tokens = [self.tokens[i] for i in ids.tolist()]
        if whole or state == 0:
            text = (self.held + b"".join(tokens[:whole])).decode("utf-8")
            self.held = b"".join(tokens[whole:])
        else:
            text, self.held = "", self.held + b"".join(tokens)
        self.state = state
        return text

    def finish(self) -> None:
        """Raise if the stream ends within a character."""
        if self.state:
            raise UnicodeDecodeError("utf-8", self.held, 0, len(self.held), "stream ends within a character")
        self.reset()

    def stream(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text parts for id chunks, which may be cut anywhere."""
        self.reset()
        for ids in chunks:
            yield self.feed(ids)
        self.finish()


_MADE: dict[tuple[str, str], tuple[Encoder, Decoder]] = {}


def codec(rank_file: bytes, pattern: str) -> tuple[Encoder, Decoder]:
    """The worker's encoder and decoder for a vocabulary, made once per process."""
    key = (hashlib.sha256(rank_file).hexdigest(), pattern)
    if key not in _MADE:
        encoder = Encoder(rank_file, pattern)
        _MADE[key] = encoder, Decoder(encoder.ranks)
    return _MADE[key]


def chunks_of(ids: np.ndarray, size: int = BLOCK_CHARS) -> Iterator[np.ndarray]:
    for start in range(0, len(ids), size):
        yield ids[start : start + size]


def _mapped(
    docs: DataFrame, text_col: str, outputs: str, row: Callable[[Encoder, Decoder, str], tuple], vocabulary: str, pattern: str
) -> DataFrame:
    """``docs`` without the text, with one ``row`` of output columns each."""
    kept = docs.drop(text_col)
    names = [part.split()[0] for part in outputs.split(", ")]
    clash = {c.lower() for c in kept.columns} & {n.lower() for n in names}
    if clash:
        raise ValueError(f"columns of the table clash with outputs: {sorted(clash)}")
    with open(vocabulary, "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary, below 1 MB
    schema = docs.select(*kept.columns).schema.simpleString()[len("struct<") : -1]
    types = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    kinds = [types[part.split()[1]] for part in outputs.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = codec(shared.value, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            rows = [row(encoder, decoder, text.as_py() or "") for text in texts]
            columns = [pa.array([r[k] for r in rows], type=kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *names])

    columns = [F.col(f"`{c}`") for c in kept.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    schema = ", ".join(part for part in (schema, outputs) if part)
    return docs.select(*columns, F.col(text_col)).mapInArrow(encode, schema)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``ids array<int>``: the ids of the whole text."""
    return _mapped(docs, text_col, "ids array<int>", lambda e, d, text: (e.encode(text).astype(np.int32),), vocabulary, pattern)


def digest_documents(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    The ids are encoded from the whole text and decoded again chunk by chunk; digests are lowercase hex, of the ids as
    little-endian unsigned 32-bit integers and of the decoded bytes.
    """

    def row(encoder: Encoder, decoder: Decoder, text: str) -> tuple[int, str, str]:
        ids = encoder.encode(text)
        decoded = hashlib.sha256()
        for part in decoder.stream(chunks_of(ids)):
            decoded.update(part.encode())
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded.hexdigest()

    return _mapped(docs, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", row, vocabulary, pattern)
