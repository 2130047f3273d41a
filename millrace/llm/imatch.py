"""I-Match fingerprints: terms within a band of inverse document frequency, in randomised subsets of that lexicon.

Document frequencies are counted over all texts. A term is in the lexicon if the share of texts that have it lies within
``BAND``; as shares add up to the mean number of distinct terms, there are at most mean / ``BAND[0]`` such terms, however
many texts there are, so the counted lexicon is small enough to be broadcast (it is joined by shuffle where it is not).
Every subset takes a term by a hash of term and subset, at one of a few rates, so texts of all lengths have subsets in
which they hold a handful of terms. A fingerprint has a part for every subset in which the text has a term: the number of
the subset and a hash of the text's sorted distinct terms in it. The likeness of two fingerprints is the share of equal
parts among those that either has; equal fingerprints have likeness 1.

Terms meet the lexicon as (term, subset) pairs, so a text has one row for each of its terms in a subset; these are hashed
by text and subset, and their hashes gathered by text. Texts are shuffled once, where they meet their edits, and every
later step finds them dealt by their key.

DataFrame functions only. Cases: a NULL text is an empty one; a text without any lexicon term in a subset has a hash of
all its terms as its only part, so short texts differ; texts that repeat under one id are one document, and each row of
it gets the same result; NULL ids come first in the order; the next of a single document is itself; an empty table gives
an empty table; only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import checkpointed, small, stored

BAND = (0.005, 0.2)
# One over the share of the lexicon that a subset takes.
RATES = (16,) * 12 + (96,) * 20 + (512,) * 16
# Bits of a part that hold the hash; the number of the subset stands above them.
HASH_BITS = 40
# Subset of the row that every text has, and the number of the part of a text that has no other.
EVERY, ALONE = -1, 63


def words_of(text: Column) -> Column:
    """Array of the text's lower-cased words of letters and digits; may hold empty strings at its ends."""
    return F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " ")


def terms_of(text: Column) -> Column:
    """Array of the text's distinct words as 64-bit hashes: distinct numbers are found by hashing, strings pair by pair."""
    return F.array_remove(F.array_distinct(F.transform(words_of(text), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def document_frequencies(texts: DataFrame, text_col: str) -> DataFrame:
    """``(term, df)``: in how many rows a term occurs; terms as 64-bit hashes."""
    terms = texts.select(terms_of(F.col(text_col)).alias("terms")).select(F.explode_outer("terms").alias("term"))
    return terms.filter("term IS NOT NULL").groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def lexicon(texts: DataFrame, text_col: str, rows: int, band: tuple[float, float] = BAND, rates: tuple[int, ...] = RATES) -> DataFrame:
    """``(term, subset)``: the terms within the band with each subset that they are in."""
    low, high = band[0] * rows, band[1] * rows
    kept = document_frequencies(texts, text_col).filter((F.col("df") >= low) & (F.col("df") <= high))
    taken = [F.when(F.pmod(F.xxhash64("term", F.lit(r)), F.lit(rate)) == 0, F.lit(r)) for r, rate in enumerate(rates)]
    return kept.select("term", F.explode(F.array_compact(F.array(*taken))).alias("subset"))


def part_of(number: Column, value: Column) -> Column:
    """A part of a fingerprint as one number."""
    return F.shiftleft(number.cast("long"), HASH_BITS).bitwiseOR(value.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among those that either fingerprint has."""
    numbers = lambda parts: F.transform(parts, lambda p: F.shiftright(p, HASH_BITS))
    either = F.size(F.array_union(numbers(a), numbers(b)))
    return F.when(a == b, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def fingerprints(texts: DataFrame, key: list[str], text_col: str, known: DataFrame, note: str | None = None) -> DataFrame:
    """``key`` columns, ``parts`` (sorted) and the column ``note`` for every distinct key; rows of one key must have the
    same text.

    ``known`` is the lexicon ``with_marker``. Where ``texts`` are partitioned by a part of the key, no row is shuffled.
    """
    noted = [F.col(note)] if note else []
    terms = texts.select(*key, *noted, terms_of(F.col(text_col)).alias("terms"))
    # What is computed once per text comes before the explode. The empty word comes first and stands for the text itself:
    # its row alone takes along what is known of the whole text.
    marked = terms.select(*key, *noted, F.xxhash64(F.sort_array("terms")).alias("whole"), F.array_prepend("terms", F.xxhash64(F.lit(""))).alias("terms"))
    spread = marked.select(*key, *noted, "whole", F.posexplode_outer("terms").alias("pos", "term"))
    first = F.col("pos") == 0
    spread = spread.select(*key, "term", F.when(first, F.col("whole")).alias("whole"), *[F.when(first, c).alias(note) for c in noted])
    found = spread.join(known, "term")
    hashed = found.groupBy(*key, "subset").agg(
        F.xxhash64(F.sort_array(F.collect_set("term"))).alias("hash"), F.max("whole").alias("whole"), *[F.max(c).alias(note) for c in noted]
    )
    part = F.when(F.col("subset") != EVERY, part_of(F.col("subset"), F.col("hash")))
    gathered = hashed.groupBy(*key).agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.max("whole").alias("whole"), *[F.max(c).alias(note) for c in noted]
    )
    parts = F.when(F.size("parts") == 0, F.array(part_of(F.lit(ALONE), F.col("whole")))).otherwise(F.col("parts"))
    return gathered.select(*key, parts.alias("parts"), *noted)


def with_marker(known: DataFrame) -> DataFrame:
    """The lexicon with the empty word in a subset of its own."""
    return known.unionByName(known.sparkSession.range(1).select(F.xxhash64(F.lit("")).alias("term"), F.lit(EVERY).alias("subset")))


def as_text(parts: Column) -> Column:
    """A fingerprint as text: its parts in hexadecimal."""
    return F.lower(F.array_join(F.transform(parts, F.hex), "."))


def next_documents(documents: DataFrame) -> DataFrame:
    """``documents`` (id, key, ...) with ``next``, the key of the next one by id and key; the first after the last.

    Rows are dealt by ranges of the id; within a range the next is a look ahead, and over its end it is the first of the
    next range. Only one row per range meets in one task.
    """
    dealt = checkpointed(documents.repartitionByRange("id", "key").withColumn("range", F.spark_partition_id()))
    firsts = dealt.groupBy("range").agg(F.min(F.struct("id", "key")).alias("first"))
    after = Window.orderBy("range")
    around = F.first("first").over(after.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = firsts.select("range", F.coalesce(F.lead("first").over(after), around).alias("following"))
    ahead = F.lead("key").over(Window.partitionBy("range").orderBy("id", "key"))
    return dealt.withColumn("next", ahead).join(ends, "range").withColumn("next", F.coalesce("next", "following.key")).drop("range", "following")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its fingerprint, and that of its edited text: the last quarter of the characters replaced by
    as many from the start of the next document.

    Returns ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("id", F.xxhash64("id", "text").alias("key"), "text")
    listed = rows.select("id", "key", F.length("text").alias("n"))
    documents = checkpointed(listed.groupBy("id", "key").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("times")))
    total = documents.agg(F.count(F.lit(1)), F.sum("times"), F.max("times")).first()
    ordered = checkpointed(next_documents(documents))
    known = checkpointed(with_marker(lexicon(rows, "text", total[1] or 0)))
    known = small(known, known.count())

    texts = rows.select("key", "text")
    wanted = ordered.select(F.col("next").alias("key"), F.col("key").alias("for"), F.floor(F.col("n") / 4).cast("int").alias("taken"))
    starts = texts.join(wanted, "key").select(F.col("for").alias("key"), "taken", F.substring("text", F.lit(1), F.col("taken")).alias("start"))
    if (total[2] or 1) > 1:
        starts = starts.groupBy("key").agg(F.first("taken").alias("taken"), F.first("start").alias("start"))
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - F.col("taken")), "start")
    both = texts.join(starts, "key").select("key", "text", edited.alias("edited"))
    versions = F.array(F.struct(F.lit(False).alias("is_edited"), F.col("text")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text")))
    hashed = both.select("key", F.sha2("edited", 256).alias("sha"), versions.alias("versions")).select("key", "sha", F.explode_outer("versions").alias("v"))
    hashed = hashed.select("key", "v.is_edited", "sha", F.col("v.text").alias("text"))
    prints, _ = stored(fingerprints(hashed, ["key", "is_edited"], "text", known, "sha"), "imatch")
    own = prints.filter("NOT is_edited").select("key", F.col("parts").alias("own"))
    changed = prints.filter("is_edited").select("key", "sha", F.col("parts").alias("changed"))
    following = own.select(F.col("key").alias("next"), F.col("own").alias("following"))
    joined = ordered.join(own, "key").join(changed, "key").join(following, "next")
    repeated = joined.withColumn("_", F.explode(F.expr("sequence(1, cast(times AS int))"))) if (total[2] or 1) > 1 else joined
    result = repeated.select(
        F.col("id").alias(id_col), F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
    return result
