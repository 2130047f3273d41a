"""Components, line dedup, I-Match and SimHash against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import imatch, line_dedup, simhash
from millrace.llm.components import connected_components
from tests.llm.conftest import HARD


def brute_components(links):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_components(spark):
    rng = random.Random(0)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)]
    links += [(200, 300 + i) for i in range(30)] + [(None, 1), (5, 5), (7, 8), (8, 7)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in found} == brute_components(links)
    assert len(found) == len({r["node"] for r in found})
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def brute_print(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text).translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprint():
    for text in ["", "  ", "One", "One two", "A b C d e\tf\x0bg", "é È  x y z", "w " * 40_000, "a b c a b c a b c"]:
        assert simhash.fingerprint(text.encode()) == brute_print(text)
    assert simhash.fingerprint(None) == 0


def test_fingerprints_use_the_hash_of_spark(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] == np.uint64(xxhash.xxh64_intdigest(b"a b c", 42)).astype(np.int64)


@pytest.mark.parametrize("subclass", [1 << 15, 40])
def test_near_links_lose_none(spark, subclass):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(150)}
    for value in list(values)[:60]:
        values |= {value ^ 1 << rng.randrange(64), value ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64), value ^ 0b111 << rng.randrange(61)}
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    want = {tuple(sorted(pair)) for pair in itertools.combinations(signed, 2) if 0 < ((pair[0] ^ pair[1]) & (1 << 64) - 1).bit_count() <= 2}
    found = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), subclass=subclass).collect()
    assert len(found) == len(want) and {tuple(sorted((r["a"], r["b"]))) for r in found} == want


def test_near_duplicates(corpus):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(300)) for _ in range(12)]
    rows = [(i, text) for i, text in enumerate(base)] + [(100 + i, text) for i, text in enumerate(base[:6])]
    rows += [(200 + i, text + " end") for i, text in enumerate(base)] + [(300 + i, t) for i, t in [(k, r[1]) for k, r in enumerate(HARD)]]
    prints = {i: brute_print(t or "") for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = {i: brute_components(links).get(i, i) for i in prints}
    found = simhash.near_duplicates(corpus(rows)).collect()
    assert {r["id"]: r["component"] for r in found} == want and len(found) == len(rows)
    kept = {r["doc_id"] for r in simhash.keep_first(corpus(rows)).collect()}
    assert kept == set(want.values())
    hard = simhash.near_duplicates(corpus(HARD)).collect()
    assert len(hard) == len(HARD) and {r["component"] for r in hard if r["fp"] == 0} == {1}
    assert simhash.near_duplicates(corpus(HARD).limit(0)).count() == 0


def lines_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_line_dedup(corpus):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)]
    fresh = lambda n: " ".join(rng.sample(words, n))
    shared, near = fresh(60), fresh(80)
    changed = near.split()
    changed[40] = "different"
    docs = [
        (10, f"{fresh(20)}\n{shared}\n---"), (11, f"{shared.upper()}!\n{fresh(20)}\n---"), (12, f"{fresh(9)}\n{near}"),
        (13, f"{' '.join(changed)}\n{fresh(12)}"), (14, f"{fresh(5)}\n\n{fresh(5)}"),
    ]
    found = lines_of(line_dedup.dedup_lines(corpus(docs)))
    by_id = dict(docs)
    assert found[10] == by_id[10] and found[12] == by_id[12] and found[14] == by_id[14]
    assert found[11] == "\n".join(by_id[11].split("\n")[1:])
    # One changed word of eighty: about six bits, near enough to share a block here.
    assert found[13] == by_id[13].split("\n")[1]
    counts = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.dedup_lines(corpus(docs)).collect()}
    assert counts[11] == (3, 1) and counts[14] == (3, 0)


def test_line_dedup_hard_cases(corpus):
    docs = corpus([*HARD, (7, "Same words here.\nOther\nsame   WORDS here"), (8, "only digits 1\nonly digits 2")])
    rows = line_dedup.dedup_lines(docs).collect()
    found = {r["doc_id"]: r["text"] for r in rows}
    assert len(rows) == 10 and found[1] is None and found[2] == "" and found[3] == "Same words here."
    assert found[7] == "Other" and found[8] == "only digits 1" and found[6] == "!!! ??? 123"
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(docs.withColumn("n_Lines", F.lit(1)))


def test_crowded_blocks_stay_connected(spark):
    rng = random.Random(5)
    left, right = rng.getrandbits(63), rng.getrandbits(63)
    prints = {(left ^ 1 << rng.randrange(21), right ^ 1 << rng.randrange(63)) for _ in range(800)}
    rows = [(k, a, b) for k, (a, b) in enumerate(sorted(prints))]
    links = line_dedup.candidate_links(spark.createDataFrame(rows, "h long, left long, right long"), bucket=16).collect()
    assert len(links) < len(rows) * 60
    assert len(set(brute_components([(r["a"], r["b"]) for r in links]).values())) == 1


def test_line_prints_by_definition(corpus):
    text = "one two three four five two"
    row = line_dedup.line_prints(corpus([(1, text)]), "doc_id", "text").first()
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in sorted(set(text.split()))]
    want = sum(1 << bit for bit in range(63) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))
    assert row["left"] == want


def test_prints_count_all_words_of_long_lines(corpus):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(700)})
    row = line_dedup.line_prints(corpus([(1, " ".join(words))]), "doc_id", "text").first()
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    assert row["left"] == sum(1 << bit for bit in range(63) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def test_bits_are_bounded_over_both_halves(spark):
    # Lines of similarity 0.8 differ by about 13 bits of a half, and by more in one half than in the other.
    rows = [(1, 0, 0), (2, (1 << 16) - 1 << 21, 0), (3, 0, (1 << 63) - 1)]
    links = line_dedup.candidate_links(spark.createDataFrame(rows, "h long, left long, right long")).collect()
    assert [(r["a"], r["b"]) for r in links] == [(1, 2)]


@pytest.mark.parametrize("edits, least", [(4, 0.97), (6, 0.93), (8, 0.85)])
def test_recall_by_similarity(corpus, edits, least):
    """Of planted lines with word similarity 0.9, 0.85 and 0.8, the share that is linked."""
    rng = random.Random(edits)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(3000)]
    rows = []
    for k in range(200):
        line = rng.sample(words, 40)
        copy = list(line)
        for place in rng.sample(range(40), edits):
            copy[place] = "new" + rng.choice(words)
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(copy))]
    found = line_dedup.dedup_lines(corpus(rows)).collect()
    assert all(r["n_removed"] == 0 for r in found if r["doc_id"] % 2 == 0)
    assert sum(r["n_removed"] for r in found) / 200 >= least


def test_crowded_lines_leave_only_after_verification(spark):
    rng = random.Random(7)
    left = rng.getrandbits(63)
    rows = [(k, left, rng.getrandbits(5)) for k in range(60)]
    true = spark.createDataFrame([(k, k + 30) for k in range(30)], "a long, b long")
    verify = lambda links: links.join(true, ["a", "b"], "left_semi")
    links = line_dedup.candidate_links(spark.createDataFrame(rows, "h long, left long, right long"), bucket=16, verify=verify)
    assert verify(links).count() == 30


def brute_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("similarity, by_letter, by_word", [(0.9, 0.97, 0.97), (0.8, 0.6, 0.9)])
def test_recall_of_short_lines(corpus, similarity, by_letter, by_word):
    """Of planted lines of 2 to 15 words with letters, or letters of one word, changed, the share that is linked."""
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    rows, kinds = [], {}
    for n in range(2, 16):
        for k in range(60):
            line = " ".join(rng.choice(words) for _ in range(n))
            edits = int(len(line) * (1 - similarity) + 1e-9)
            copy, wordwise = list(line), k % 2 == 0
            places = [i for i, c in enumerate(line) if c != " "]
            if wordwise:
                start = rng.choice([i for i in places if i == 0 or line[i - 1] == " "])
                end = (line + " ").index(" ", start)
                places = places[places.index(start) : places.index(start) + end - start]
            for place in rng.sample(places, min(edits, len(places))):
                copy[place] = rng.choice("qrstuvwxyz")
            copy = "".join(copy)
            assert 1 - brute_levenshtein(line, copy) / len(line) >= similarity - 1e-9
            kinds[len(rows) + 1] = wordwise
            rows += [(len(rows), line), (len(rows) + 1, copy)]
    found = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(corpus(rows)).collect()}
    for wordwise, least in ((False, by_letter), (True, by_word)):
        copies = [i for i, kind in kinds.items() if kind == wordwise]
        share = sum(found[i] for i in copies) / len(copies)
        print(similarity, wordwise, share)
        assert share >= least
    assert all(found[i] == 0 for i in found if i not in kinds)


def test_short_lines_by_brute_force(corpus):
    """Lines of up to 14 characters: every pair within the similarity is linked, no other."""
    rng = random.Random(12)
    lines = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(90)})
    near = [(a, b) for a, b in itertools.combinations(lines, 2) if 1 - brute_levenshtein(a, b) / max(len(a), len(b)) >= 0.8]
    roots = brute_components([(lines.index(a), lines.index(b)) for a, b in near])
    found = line_dedup.dedup_lines(corpus(list(enumerate(lines)))).collect()
    assert near and {r["doc_id"]: r["n_removed"] for r in found} == {i: int(roots.get(i, i) != i) for i in range(len(lines))}


def test_crowded_blocks_in_tiles(spark, monkeypatch):
    rng = random.Random(13)
    left = rng.getrandbits(63)
    monkeypatch.setattr(line_dedup, "TILE", 16)
    rows = [(k, left, rng.getrandbits(63)) for k in range(150)]
    want = {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if (a[2] ^ b[2]).bit_count() <= 26}
    links = line_dedup.candidate_links(spark.createDataFrame(rows, "h long, left long, right long"), bits=26, bucket=16).collect()
    pairs = [(r["a"], r["b"]) for r in links]
    assert set(pairs) <= want and brute_components(pairs) == brute_components(want)


def test_line_dedup_keeps_columns_of_any_name(corpus):
    docs = corpus([(1, "one two three four\nother words"), (2, "one two three four")])
    named = docs.select("*", *[F.lit(c).alias(c) for c in ("_key", "_lines", "_removed", "key", "row", "lines", "removed", "h", "a.b")])
    rows = {r["doc_id"]: r for r in line_dedup.dedup_lines(named).collect()}
    assert rows[2]["n_removed"] == 1 and rows[2]["lines"] == "lines" and rows[1]["_key"] == "_key" and rows[1]["a.b"] == "a.b"


def test_imatch_edits(corpus):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(4)) for _ in range(500)]
    rows = [(i * 3, " ".join(rng.choice(words) for _ in range(rng.randint(0, 120)))) for i in range(60)]
    rows += [(1000, rows[5][1]), (1001, None), (1002, "é😀 ab")]
    found = {r["doc_id"]: r for r in imatch.compare_with_edits(corpus(rows)).collect()}
    texts = [(i, t or "") for i, t in sorted(rows)]
    prints = {i: found[i]["fingerprint"].split(".") for i, _ in texts}
    for k, (i, text) in enumerate(texts):
        j, following = texts[(k + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert found[i]["n_chars"] == len(text)
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        numbers = [{int(part, 16) >> imatch.HASH_BITS for part in prints[x]} for x in (i, j)]
        want = 1.0 if prints[i] == prints[j] else len(set(prints[i]) & set(prints[j])) / len(numbers[0] | numbers[1])
        assert found[i]["near_next"] == pytest.approx(want)
    assert found[1000]["fingerprint"] == found[15]["fingerprint"]
    near = [r["near_edited"] > r["near_next"] for r in found.values() if r["n_chars"] > 100]
    assert np.mean(near) > 0.8


def brute_prints(texts, all_texts):
    """The fingerprint of each text by definition, document frequencies from ``all_texts``."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def of_text(word):
        return signed(xxhash.xxh64_intdigest(word.encode(), 42))

    def of_numbers(*numbers):
        seed = 42
        for value, size in numbers:
            seed = xxhash.xxh64_intdigest(value.to_bytes(size, "little", signed=True), seed)
        return signed(seed)

    def terms(text):
        return {of_text(w) for w in re.sub(r"[^\w]|_", " ", text.lower()).split()}

    counts = Counter(t for text in all_texts for t in terms(text))
    low, high = (share * len(all_texts) for share in imatch.BAND)
    mask = (1 << imatch.HASH_BITS) - 1
    found = []
    for text in texts:
        own, parts = terms(text), []
        for r, rate in enumerate(imatch.RATES):
            held = sorted(t for t in own if low <= counts[t] <= high and of_numbers((t, 8), (r, 4)) % rate == 0)
            if held:
                parts.append(r << imatch.HASH_BITS | of_numbers(*[(t, 8) for t in held]) & mask)
        parts = parts or [imatch.ALONE << imatch.HASH_BITS | of_numbers(*[(t, 8) for t in sorted(own)]) & mask]
        found.append(".".join(f"{p:x}" for p in sorted(parts)))
    return found


def test_imatch_every_fingerprint_by_brute_force(corpus):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnopé") for _ in range(4)) for _ in range(900)]
    rows = [(i, " ".join(rng.choice(words[: rng.choice((30, 900))]) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(500, None), (501, "Never seen, elsewhere! 12 x"), (502, rows[7][1])]
    texts = [t or "" for _, t in sorted(rows)]
    edited = [t[: len(t) - len(t) // 4] + texts[(k + 1) % len(texts)][: len(t) // 4] for k, t in enumerate(texts)]
    got = sorted(imatch.compare_with_edits(corpus(rows)).collect(), key=lambda r: r["doc_id"])
    assert [r["fingerprint"] for r in got] == brute_prints(texts, texts)
    assert [r["edited_fingerprint"] for r in got] == brute_prints(edited, texts)
    assert sum(r["fingerprint"].count(".") for r in got) > 1000


def test_imatch_hard_cases(corpus):
    rows = imatch.compare_with_edits(corpus(HARD)).collect()
    assert len(rows) == len(HARD)
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 3}) == 1
    one = imatch.compare_with_edits(corpus([(9, "abcd efgh")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcd efab").hexdigest() and one["near_next"] == 1.0
    assert imatch.compare_with_edits(corpus(HARD).limit(0)).count() == 0


def test_crowded_lines_meet_one_representative(spark):
    """A line of a crowded group leaves its block with one pair, not with one for each representative."""
    rng = random.Random(17)
    left, right = rng.getrandbits(63), rng.getrandbits(63)
    rows = [(k, left, right ^ 1 << k % 60) for k in range(300)]
    seen = []
    verify = lambda links: seen.append(links.count()) or links
    links = line_dedup.candidate_links(spark.createDataFrame(rows, "h long, left long, right long"), bucket=16, verify=verify).collect()
    # Four blocks, two of them changed in some lines.
    assert seen[0] <= 4 * len(rows)
    assert set(brute_components([(r["a"], r["b"]) for r in links]).values()) == {0}


def test_crowded_long_lines_are_compared_where_they_meet(corpus, monkeypatch):
    """Lines of one template that are not similar make no pairs to be joined with their texts."""
    rng = random.Random(19)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(4000)]
    base = rng.sample(words, 40)
    rows = []
    for k in range(120):
        line = base[:28] + rng.sample(words, 12)
        rows.append((k, " ".join(line)))
    # Three words of forty are changed in the copies.
    copies = [(k, " ".join([*text.split()[:37], "x", "y", "z"])) for k, (_, text) in enumerate(rows[:30], len(rows))]
    judged = []
    verified = line_dedup.verified_links

    def counted(*args):
        judged.append(next(a for a in args if a.columns[:2] == ["a", "b"]).count())
        return verified(*args)

    monkeypatch.setattr(line_dedup, "verified_links", counted)
    monkeypatch.setattr(line_dedup, "BITS", 60)
    found = {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(corpus([*rows, *copies])).collect()}
    assert found == {k: int(k >= len(rows)) for k in range(len(rows) + len(copies))}
    assert sum(judged) < 12 * len(found)


def test_counts_of_letters_bound_edits(spark):
    """Differing bits of the counts and the lengths' difference are at most twice the edits; lines at the bound are linked."""
    rng = random.Random(23)
    rows = []
    for _ in range(300):
        line = "".join(rng.choice("abé z") for _ in range(rng.randint(1, 60)))
        copy = list(line)
        for _ in range(rng.randint(0, 12)):
            place = rng.randrange(len(copy) + 1)
            copy[place : place + rng.randint(0, 1)] = rng.choice(["", "a", "z", "é"])
        rows.append((line, "".join(copy)))
    tallies = lambda c: line_dedup._tallies(F.col(c))
    pairs = spark.createDataFrame(rows, "x string, y string")
    for r in pairs.select("x", "y", F.array(*tallies("x")).alias("s"), F.array(*tallies("y")).alias("t")).collect():
        apart = sum((s ^ t).bit_count() for s, t in zip(r["s"], r["t"], strict=True)) + abs(len(r["x"]) - len(r["y"]))
        assert apart <= 2 * brute_levenshtein(r["x"], r["y"])


def test_verification_leaves_out_what_is_connected(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    near = [" ".join([*words[:k], "other", *words[k + 1 :]]) for k in range(12)]
    hashes = lambda lines: {r["line"]: r["h"] for r in lines.select("line", F.xxhash64("line").alias("h")).collect()}
    of = hashes(spark.createDataFrame([(" ".join(words[k:] + words[:k]),) for k in range(13, 28)] + [(line,) for line in near], "line string"))
    least = min(of[line] for line in near)
    for above in (True, False):
        # A line apart from them all, with a greater or a smaller hash than theirs.
        far = next(line for line, h in of.items() if line not in near and (h > least) == above)
        lines = spark.createDataFrame([(line,) for line in [*near, far]], "line string")
        pairs = list(itertools.combinations(sorted(of[line] for line in [*near, far]), 2))
        links = line_dedup.verified_links(lines, spark.createDataFrame(pairs, "a long, b long"), 0.8)
        groups = connected_components(links, "a", "b").collect()
        assert {r["node"] for r in groups} == {of[line] for line in near} and len({r["component"] for r in groups}) == 1
        # All pairs of the near lines are 66.
        assert links.count() == (11 if above else 66)


@pytest.mark.parametrize("text", ["Ab\u00e4 c", "a  b", " a-b ", "a \n b", "a.\nb", "\n\n", "A1 B", "\u0130x \u4e2d\u6587\u3002y", "a b", "- -\n-"])
def test_normalised_lines_by_definition(spark, text):
    lines = spark.createDataFrame([(text,)], "text string").select(line_dedup.normalised_lines(F.col("text")).alias("l")).first()["l"]
    flat = "".join(c if c.isalpha() or c == "\n" else " " for c in text.lower())
    assert lines == [re.sub(" +", " ", line) for line in flat.split("\n")]


def test_words_are_counted_in_code_that_is_compiled(spark, capsys):
    """HotSpot never compiles methods of more than 8000 bytes; those that see every word of a line must be shorter."""
    lines = spark.createDataFrame([(1, 1, 1, 0, "a b")], "key long, id long, row long, pos int, line string")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    line_dedup.prints_of(lines).explain("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", before)
    stages = capsys.readouterr().out.split("== Subtree")[1:]
    # The stage of the words is the one that explodes them: its code is named after that step.
    sizes = [int(re.search(r"maxMethodCodeSize:(\d+)", stage)[1]) for stage in stages if re.search(r"\bgenerate_", stage)]
    print(sizes)
    assert sizes and max(sizes) <= 8000


@pytest.mark.parametrize("n", [1, 6, 7, 8, 254, 255, 256, 700])
def test_prints_of_lines_of_any_length(corpus, n):
    """Both halves by definition, around what is added up at once and where counters become wider."""
    rng = random.Random(n)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n)]
    row = line_dedup.line_prints(corpus([(1, " ".join(words + words[:2]))]), "doc_id", "text").first()
    first = [xxhash.xxh64_intdigest(w.encode(), 42) for w in sorted(set(words))]
    second = [xxhash.xxh64_intdigest((1).to_bytes(4, "little"), h) for h in first]
    for half, hashes in (("left", first), ("right", second)):
        assert row[half] == sum(1 << bit for bit in range(63) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def test_short_lines_meet_without_any_word(spark):
    """A short line shares a key with itself less any of its words, repeated ones included, but not with any line."""
    words = ["one", "two", "one", "three", "four"]
    lines = [words, *[words[:k] + words[k + 1 :] for k in range(5)], ["five", "two", "six", "three", "seven"]]
    rows = line_dedup.line_keys(spark.createDataFrame([(" ".join(line),) for line in lines], "line string")).collect()
    keys = {r["line"]: set(r["keys"]) for r in rows}
    whole = keys[" ".join(words)]
    assert all(whole & keys[" ".join(line)] for line in lines[:6])
    assert not whole & keys[" ".join(lines[6])]


def recorded_tables(monkeypatch):
    """Rows of every table that line dedup stores, by name, and what is left of them."""
    rows, paths, gone = [], [], []
    store, drop = line_dedup.stored, line_dedup.discard

    def stored(df, name):
        table, path = store(df, name)
        rows.append((name, table.count()))
        paths.append(path)
        return table, path

    def discard(session, path):
        gone.append(path)
        drop(session, path)

    monkeypatch.setattr(line_dedup, "stored", stored)
    monkeypatch.setattr(line_dedup, "discard", discard)
    return lambda name: [n for at, n in rows if at == name], lambda: set(paths) - set(gone)


def test_blocks_are_reduced_and_compared_in_passes(corpus, monkeypatch):
    """No pass over keys or members has all of them, together they have the same, and no table stays."""
    rng = random.Random(29)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice((1, 3, 6, 24, 150)))) for _ in range(120)]
    texts += [text.replace("a", "b", 1) for text in texts[:40]]
    docs = corpus([(k, f"{text}\n{rng.choice(texts)}") for k, text in enumerate(texts)])
    tables, left = recorded_tables(monkeypatch)
    want = lines_of(line_dedup.dedup_lines(docs))
    whole, members = tables("line-inside"), tables("line-members")
    assert len(whole) == 1 and whole == members
    monkeypatch.setattr(line_dedup, "PASS_LINES", 30)
    monkeypatch.setattr(line_dedup, "PASS_ROWS", 1)
    assert lines_of(line_dedup.dedup_lines(docs)) == want
    passes, found = tables("line-inside")[1:], tables("line-found")[1:]
    assert len(passes) == 4 and sum(passes) == whole[0] and max(passes) < whole[0] / 2
    assert tables("line-members") == members * 2 and len(found) > 1
    assert not left()


def test_tiles_of_crowded_blocks_are_compared_in_passes(spark, monkeypatch):
    rng = random.Random(31)
    left = rng.getrandbits(63)
    monkeypatch.setattr(line_dedup, "TILE", 16)
    monkeypatch.setattr(line_dedup, "PASS_ROWS", 300)
    rows = [(k, left, rng.getrandbits(63)) for k in range(150)]
    want = {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if (a[2] ^ b[2]).bit_count() <= 26}
    tables, kept = recorded_tables(monkeypatch)
    links = line_dedup.candidate_links(spark.createDataFrame(rows, "h long, left long, right long"), bits=26, bucket=16).collect()
    pairs = [(r["a"], r["b"]) for r in links]
    assert set(pairs) <= want and brute_components(pairs) == brute_components(want)
    # 150 lines of two blocks with ten parts each are 3,000 rows of tiles; blocks compared in passes before that make tables too.
    assert len(tables("line-found")) > 3000 // 150
    assert not kept()
