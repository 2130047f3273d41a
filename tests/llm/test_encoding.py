"""Byte-level BPE and token shards against the libraries, and round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, token_files
from tests.llm.conftest import HARD

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as file:
        data = file.read()
    ranks = bpe.read_ranks(data)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, decoder = bpe.codec(data, public_tokenizers.PATTERN)
    return encoder, decoder, library


def random_texts(seed, count, longest=40):
    rng = random.Random(seed)
    letters = [chr(c) for c in [*range(32, 127), *range(0xC0, 0x180), 0x3A3, 0x4E2D, 0x1F600, 0x1C, 0x85, 0xA0, 0x3000, 0x301, 9, 10, 13]]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(count)]


def test_encode_equals_library_and_decodes_back(codec):
    encoder, decoder, library = codec
    for text in [*random_texts(1, 1500), "the  thinning of\n\n things'll  ", " " * 50, "a" * 300]:
        ids = encoder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert "".join(decoder.stream(bpe.chunks_of(ids, 3))) == text


def test_a_full_table_is_cleared_and_every_piece_goes_through_the_machine(codec):
    ranks = codec[0].ranks
    made, small, bare = (bpe.Transducer(ranks, max_transitions=most) for most in (1 << 30, 100, 0))
    rng = random.Random(2)
    for k in range(800):
        piece = "".join(rng.choice("etaoinshrdlu" if k % 3 else "aé漢😀 .") for _ in range(rng.randint(1, 24))).encode()
        assert made.encode(piece) == small.encode(piece) == bare.encode(piece) == bpe.merge(piece, ranks)
        assert small.size <= 100 and sum(map(len, small.table)) == small.size
    assert small.moved > 1000 and (made.uncovered, small.uncovered, bare.uncovered) == (0, 0, 0)


def test_states_are_shared_whatever_tokens_wait(codec):
    ranks = codec[0].ranks
    machine, rng = bpe.Transducer(ranks), random.Random(4)
    parts = ["the", "and", "ing", "ion", "ou", "er", "sh", "ti", "nd", "heb", "rea", "an"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 6))).encode() for _ in range(3000)]
    for word in words:
        assert machine.encode(word) == bpe.merge(word, ranks)
    # Were the waiting tokens part of a state, it would be 7,752 steps.
    assert machine.moved < 5500


def test_strings_that_come_often_outlive_a_full_cache():
    calls = []
    known = bpe.Remembered(lambda string: calls.append(string) or string.encode(), most=10)
    for k in range(100):
        assert known["often"] == b"often" and known[f"once {k}"] == f"once {k}".encode()
        assert len(known) <= 10 and len(known.before) <= 10
    assert calls.count("often") == 1


def test_long_texts_are_cut_where_pieces_end(codec):
    encoder, _, library = codec
    text = " ".join(random_texts(3, 6000))
    assert len(text) > bpe.BLOCK_CHARS
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_decoder_holds_back_unfinished_characters(codec):
    encoder, decoder, _ = codec
    single = {token: rank for token, rank in encoder.ranks.items() if len(token) == 1}
    ids = np.array([single[bytes([b])] for b in "é😀".encode()])
    decoder.reset()
    assert [decoder.feed(ids[k : k + 1]) for k in range(len(ids))] == ["", "é", "", "", "", "😀"]
    decoder.finish()
    with pytest.raises(UnicodeDecodeError):
        list(decoder.stream([ids[:1]]))
    with pytest.raises(UnicodeDecodeError):
        list(decoder.stream([ids[1:2]]))


def test_digest_documents(corpus, codec):
    docs = corpus(HARD)
    rows = bpe.digest_documents(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(HARD) and rows[0]["source"] == "src"
    ids = codec[2].encode_ordinary("Same words here.")
    row = next(r for r in rows if r["doc_id"] == 3)
    assert row["n_tokens"] == len(ids)
    assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert row["decoded_sha256"] == hashlib.sha256(b"Same words here.").hexdigest()
    nothing = next(r for r in rows if r["doc_id"] == 1)
    assert nothing["n_tokens"] == 0 and nothing["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.digest_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.digest_documents(docs.withColumn("N_tokens", F.lit(1)), RANKS, public_tokenizers.PATTERN)
    encoded = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).filter("doc_id = 3").first()
    assert encoded["ids"] == ids


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    rng = np.random.default_rng(bits)
    for count in (0, 1, 63, 64, 65, 1000):
        ids = rng.integers(0, 1 << bits, count, dtype=np.uint64)
        words = token_files.pack(ids, bits)
        assert len(words) == -(-count // 64) * bits
        assert (token_files.unpack(words, bits, count) == ids).all()


def test_shard_random_access():
    rng = np.random.default_rng(0)
    documents = [rng.integers(0, 49_408, n, dtype=np.uint32) for n in (5, 0, 9000, 1, 4096)]
    shard = token_files.Shard.open(token_files.make_shard([7, None, 8, 9, 10], documents, 16))
    for k, ids in enumerate(documents):
        assert (shard.document(k) == ids).all()
    everything = np.concatenate(documents)
    for first, last in ((0, 3), (4090, 4100), (100, 100), (8191, 13_000)):
        assert (shard.read(first, last) == everything[first:last]).all()
    with pytest.raises(ValueError):
        token_files.make_shard([1], [np.array([70_000])], 16)
    with pytest.raises(ValueError):
        token_files.Shard.open(b"\0" * 48)


def test_word_encoder_equals_library():
    library = Tokenizer.from_file(WORDS)
    texts = [*random_texts(5, 1500), "Hello, it's  x!?. ÀÉ İ,", "a" * 100 + " b"]
    with open(WORDS, encoding="utf-8") as file:
        encoder = token_files.WordEncoder(file.read(), end_id=1)
    for text, ids in zip(texts, encoder.encode_batch(texts)):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


def test_word_encoder_with_letters_that_come_apart():
    library = Tokenizer.from_file(WORDS)
    texts = ["\u09b9\u09df one two three", "\u0958\u095f \ufb2a\ufb4e four", "\u09b9\u09df, five", "x\u0344 six \u0340", "one two three four five six"]
    with open(WORDS, encoding="utf-8") as file:
        encoder = token_files.WordEncoder(file.read(), end_id=1)
    for text, ids in zip(texts, encoder.encode_batch(texts)):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 1]


def test_shards_of_documents(spark, corpus, tmp_path):
    docs = corpus(HARD)
    token_files.write_shards(docs, str(tmp_path / "shards"), WORDS, end_id=1, shard_ids=50)
    rows = token_files.read_documents(spark, str(tmp_path / "shards")).orderBy("start", "n_tokens").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 3, 4, 5, 6]
    library, place = Tokenizer.from_file(WORDS), 0
    by_id = {r[0]: r[1] or "" for r in HARD}
    for row in rows:
        ids = [*library.encode(by_id[row["doc_id"]], add_special_tokens=False).ids, 1]
        assert (row["start"], row["n_tokens"]) == (place, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        place += len(ids)
    token_files.write_shards(docs.limit(0), str(tmp_path / "none"), WORDS, end_id=1)
    assert token_files.read_documents(spark, str(tmp_path / "none")).count() == 0
