"""Token ids as bit-packed shards: every id in the fewest bits that the vocabulary needs, read back by numpy.

A shard is one self-contained binary value: a header, the documents' ids and where their ids of tokens begin, the byte
offset of every block, and blocks of ``BLOCK`` ids. Within a block, groups of 64 ids fill exactly ``bits`` 64-bit words,
so packing and unpacking are 64 vectorised shifts whatever the width, and any range of ids is read from its blocks alone.

Shards are written and read by Spark as a binary column, one row a shard, so they can lie in any store that Spark reaches
and a lost task leaves no half-written file. Documents are dealt by ranges of their id and sorted, hence the shards, in
the order of (part, seq), hold all documents in ascending order; a document's place among all ids is its place in its
part plus the total of the parts before, of which there are as many as tasks.

Cases: a NULL text is an empty one and has the end id alone; a NULL document id comes first and is read back as NULL;
repeated ids are written each, in an order fixed by their texts; an empty table gives an empty table; further columns
are not written. Document ids are 64-bit integers.
"""

from __future__ import annotations

import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.common import tuned_batches

MAGIC = 0x314B5054  # "TPK1"
GROUP = 64
BLOCK = 4_096
SHARD_IDS = 1 << 20
MAX_REMEMBERED = 1 << 20
LONGEST_REMEMBERED = 64
# Punctuation that begins no contraction.
CLOSING = ".,;:!?"
# Words that are handed over as one list.
JOINED = 200
SHARD_COLUMNS = "part int, seq int, start_in_part long, n_docs long, n_ids long, data binary"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Ids in 64-bit words, ``bits`` words for every 64 ids; the last group is filled up with zeros."""
    groups = -(-len(ids) // GROUP)
    values = np.zeros(groups * GROUP, dtype=np.uint64)
    values[: len(ids)] = ids
    values = np.ascontiguousarray(values.reshape(groups, GROUP).T)
    words = np.zeros((bits, groups), dtype=np.uint64)
    for k in range(GROUP):
        word, shift = divmod(k * bits, 64)
        words[word] |= values[k] << np.uint64(shift)
        if shift + bits > 64:
            words[word + 1] |= values[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).reshape(-1)


def unpack(words: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of whole groups of words."""
    words = np.ascontiguousarray(words.reshape(-1, bits).T)
    values = np.empty((GROUP, words.shape[1]), dtype=np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(GROUP):
        word, shift = divmod(k * bits, 64)
        value = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | words[word + 1] << np.uint64(64 - shift)
        values[k] = value & mask
    return np.ascontiguousarray(values.T).reshape(-1)[:count]


@dataclass
class Shard:
    """A shard opened for reading; nothing is unpacked until it is asked for."""

    bits: int
    block: int
    doc_ids: np.ndarray
    known: np.ndarray
    starts: np.ndarray
    offsets: np.ndarray
    data: memoryview

    @classmethod
    def open(cls, data: bytes) -> Shard:
        magic, bits, block, docs, ids = np.frombuffer(data, "<u8", 5).tolist()
        if magic != MAGIC:
            raise ValueError("not a shard of packed token ids")
        blocks, at, parts = -(-ids // block), 40, []
        for dtype, count in (("<i8", docs), ("u1", docs), ("<u8", docs + 1), ("<u8", blocks + 1)):
            parts.append(np.frombuffer(data, dtype, count, at))
            at += parts[-1].nbytes
        return cls(bits, block, *parts, memoryview(data)[at:])

    def read(self, first: int, last: int) -> np.ndarray:
        """Ids ``first`` to ``last`` (exclusive), from the blocks that hold them."""
        if first >= last:
            return np.zeros(0, dtype=np.uint32)
        low, high = first // self.block, -(-last // self.block)
        words = np.frombuffer(self.data[self.offsets[low] : self.offsets[high]], "<u8")
        values = unpack(words, self.bits, len(words) // self.bits * GROUP)
        return values[first - low * self.block : last - low * self.block]

    def document(self, k: int) -> np.ndarray:
        """Ids of the k-th document."""
        return self.read(int(self.starts[k]), int(self.starts[k + 1]))


def make_shard(doc_ids: list[int | None], documents: list[np.ndarray], bits: int, block: int = BLOCK) -> bytes:
    """The bytes of a shard."""
    ids = np.concatenate(documents) if documents else np.zeros(0, dtype=np.uint32)
    if len(ids) and int(ids.max()).bit_length() > bits:
        raise ValueError(f"id {ids.max()} needs more than {bits} bits")
    starts = np.concatenate([[0], np.cumsum([len(d) for d in documents])]).astype("<u8")
    packed = pack(ids, bits).astype("<u8").tobytes()
    blocks = -(-len(ids) // block)
    offsets = np.minimum(np.arange(blocks + 1, dtype=np.uint64) * np.uint64(block // GROUP * bits * 8), len(packed))
    header = np.array([MAGIC, bits, block, len(doc_ids), len(ids)], dtype="<u8")
    numbers = np.array([d or 0 for d in doc_ids], dtype="<i8")
    known = np.array([d is not None for d in doc_ids], dtype="u1")
    return b"".join([*(x.tobytes() for x in (header, numbers, known, starts, offsets.astype("<u8"))), packed])


class WordEncoder:
    """Whole texts by the tokenizers library, word by word: this vocabulary drops white space and case, and joins neither
    words nor letters and punctuation, so the ids of a text are those of its parts in order. Parts are remembered up to a
    bound."""

    def __init__(self, tokenizer: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.end = np.array([end_id], dtype="<u4").tobytes()
        self.known: dict[str, bytes] = {"": b""}

    @staticmethod
    def words(text: str | None) -> list[str]:
        """Parts between spaces and line ends, in lower case where that is sure to be what the library does."""
        text = (text or "").replace("\n", " ")
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split(" ")
        return text.lower().split(" ")

    def encode_parts(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """(part, its ids), by one call for many parts: those of letters alone in lists. The library normalises and cuts
        every part of a list by itself, and numbers the ids by the part, whatever a part becomes."""
        plain = [part for part in parts if part.lower().isalpha()]
        others = [part for part in parts if not part.lower().isalpha()]
        texts = [plain[k : k + JOINED] for k in range(0, len(plain), JOINED)]
        for start in range(0, len(texts), 100):
            encodings = self.tokenizer.encode_batch(texts[start : start + 100], is_pretokenized=True, add_special_tokens=False)
            for own, encoding in zip(texts[start : start + 100], encodings):
                ids = np.array(encoding.ids, dtype="<u4").tobytes()
                at = (np.searchsorted(np.array(encoding.word_ids), np.arange(len(own) + 1)) * 4).tolist()
                yield from zip(own, [ids[x:y] for x, y in zip(at, at[1:])])
        for start in range(0, len(others), 10_000):
            some = others[start : start + 10_000]
            for part, encoding in zip(some, self.tokenizer.encode_batch(some, add_special_tokens=False)):
                ids = encoding.ids
                yield part, struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, known: dict[str, bytes], words: set[str]) -> None:
        """Encode words that are not known; punctuation after a letter is a part of its own."""
        cut = []
        for word in words:
            core = word.rstrip(CLOSING)
            # Composed letters may come apart into a letter and a mark, and marks join with punctuation.
            if core and core != word and unicodedata.normalize("NFC", core)[-1].lower().isalpha():
                cut.append((word, core, word[len(core) :]))
        whole = words.difference([word for word, _, _ in cut])
        whole.update([core for _, core, _ in cut], [tail for _, _, tail in cut])
        known.update(self.encode_parts(list(whole - known.keys())))
        for word, core, tail in cut:
            known[word] = known[core] + known[tail]

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text, each with the end id."""
        split = [self.words(text) for text in texts]
        if len(self.known) > MAX_REMEMBERED:
            self.known = {"": b""}
        known = self.known
        new = {word for words in split for word in words if word not in known}
        long = {word for word in new if len(word) > LONGEST_REMEMBERED}
        self.learn(known, new - long)
        if long:
            known = dict(known)
            self.learn(known, long)
        return [np.frombuffer(b"".join([*map(known.__getitem__, words), self.end]), dtype="<u4") for words in split]


_ENCODERS: dict[tuple[int, int], WordEncoder] = {}


def worker_encoder(tokenizer: str, end_id: int) -> WordEncoder:
    key = (hash(tokenizer), end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(tokenizer, end_id)
    return _ENCODERS[key]


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode every whole text, append the end id, and write the shards to ``path`` in ascending order of document ids."""
    spark = tuned_batches(docs.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as file:
        text = file.read()
    bits = bits_for(max(Tokenizer.from_str(text).get_vocab_size(with_added_tokens=True), end_id + 1))
    shared = spark.sparkContext.broadcast(text)  # one vocabulary, below 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = worker_encoder(shared.value, end_id), TaskContext.get().partitionId()
        doc_ids, documents, held, written, seq = [], [], 0, 0, 0

        def shard() -> pa.RecordBatch:
            data = make_shard(doc_ids, documents, bits)
            values = ([part], [seq], [written], [len(doc_ids)], [held], [data])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = [column.split()[0] for column in SHARD_COLUMNS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_batch(batch.column(1).to_pylist())):
                doc_ids.append(doc_id)
                documents.append(ids)
                held += len(ids)
                if held >= shard_ids:
                    yield shard()
                    doc_ids, documents, held, written, seq = [], [], 0, written + held, seq + 1
        if doc_ids:
            yield shard()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    dealt = rows.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))
    dealt.mapInArrow(run, SHARD_COLUMNS).write.option("compression", "zstd").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, unpacked from the shards at ``path``.

    ``start`` counts the ids of all documents before it.
    """
    shards = spark.read.schema(SHARD_COLUMNS).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per writing task
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = shards.join(F.broadcast(bases), "part").select((F.col("base") + F.col("start_in_part")).alias("base"), "data")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column(0), batch.column(1)):
                shard = Shard.open(data.as_py())
                ids = shard.read(0, int(shard.starts[-1])).astype("<u4")
                starts = shard.starts.astype(np.int64)
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                columns = [
                    pa.array(shard.doc_ids, pa.int64(), mask=shard.known == 0), pa.array(starts[:-1] + base.as_py()),
                    pa.array(np.diff(starts)), pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
