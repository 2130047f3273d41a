"""Language ID, toxicity and personal data: held-out accuracy, definitions by brute force, hard cases."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import language_id, pii, toxicity
from tests.llm.conftest import HARD

SYLLABLES = {"aa": ["ka", "to", "mi", "re"], "bb": ["sch", "ein", "ung", "der"], "cc": ["eau", "oix", "que", "ère"]}


def invented(rng, lang, words):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def languages():
    rng = random.Random(0)
    return [(i, invented(rng, lang := rng.choice(list(SYLLABLES)), rng.randint(3, 60)), lang) for i in range(300)]


def test_language_held_out(corpus, languages):
    docs = corpus(languages)
    model = language_id.fit(docs, F.col("doc_id") % 5 != 0)
    rows = language_id.predict(docs, model).filter("doc_id % 5 = 0").collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_does_not_learn_from_held_out_rows(corpus, languages):
    moved = [(i, t, lang if i % 5 else "zz") for i, t, lang in languages]
    a = language_id.predict(corpus(languages), language_id.fit(corpus(languages), F.col("doc_id") % 5 != 0))
    b = language_id.predict(corpus(moved), language_id.fit(corpus(moved), F.col("doc_id") % 5 != 0))
    pick = lambda df: sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in df.collect())
    assert pick(a) == pick(b)


def test_kernel_by_definition():
    texts = ["banana", "bandana Band", "xyz"]
    sets = [set(language_id.grams(t).tolist()) for t in texts]
    lowered = [t.lower() for t in texts]
    assert [len(s) for s in sets] == [len({t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}) for t in lowered]
    model = language_id.fit_kernel(texts, ["a", "a", "b"])
    values = model.kernel([language_id.grams(t) for t in texts])
    want = [[len(x & y) / np.sqrt(len(x) * len(y)) for y in sets] for x in sets]
    assert np.allclose(values, want, atol=1e-5)


def test_language_hard_cases(corpus, languages):
    docs = corpus([*HARD, (7, "123"), *[(100 + i, t, lang) for i, t, lang in languages]])
    found = language_id.predict(docs, language_id.fit(docs, F.lit(True))).collect()
    assert len(found) == len(HARD) + 1 + len(languages)
    assert {r["lang_pred"] for r in found if r["doc_id"] in (1, 2, 6, 7)} == {"und"}
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language_id.fit(none, F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), language_id.fit(docs, F.lit(True))).count() == 0
    with pytest.raises(ValueError):
        language_id.predict(docs.withColumn("Score", F.lit(1)), None)
    named = docs.withColumn("_judged", F.lit("x")).withColumn("a.b", F.lit("y"))
    rows = language_id.predict(named, language_id.fit(docs, F.lit(True))).collect()
    assert len(rows) == len(found) and all(r["_judged"] == "x" and r["a.b"] == "y" for r in rows)


def test_ordinal_gradient_finds_ordered_thresholds():
    rng = np.random.default_rng(0)
    x = (rng.random((600, 6)) < 0.3).astype(np.float32)
    sums = x @ np.array([3.0, 2, 0, 0, -1, 0])
    grades = (sums + rng.logistic(size=600) * 0.3 > 1.5).astype(int) + (sums + rng.logistic(size=600) * 0.3 > 3.5)
    weights, thresholds = toxicity.fit_ordinal(x, grades)
    assert thresholds[0] < thresholds[1] and weights[0] > weights[1] > abs(weights[2])
    model = toxicity.OrdinalModel({}, weights, thresholds)
    above = model.survival(x @ weights)
    assert np.mean(above.sum(axis=1).round() == grades) > 0.85
    assert (above[:, 0] >= above[:, 1]).all()


@pytest.fixture(scope="module")
def toxic_rows():
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = invented(rng, "aa", rng.randint(5, 60)).split()
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["gruns", "blorf"]) + rng.choice(SYLLABLES["bb"]))
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark, corpus, toxic_rows):
    rows, labels = toxic_rows
    labels = [x for x in labels if x[0] < 300] + [(None, 1, 1), (3, 1, None)]
    docs = corpus(rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = toxicity.score(docs, model).filter("doc_id >= 300").collect()
    assert all(r["toxic"] == (r["doc_id"] % 4 == 0) for r in found)
    assert all(0 <= r["severity"] <= 2 for r in found)


def test_toxicity_hard_cases(spark, corpus, toxic_rows):
    rows, labels = toxic_rows
    schema = "doc_id long, quality int, toxic int"
    docs = corpus([*HARD, *[(1000 + i, t) for i, t in rows]])
    shifted = spark.createDataFrame([(1000 + i, q, t) for i, q, t in labels], schema)
    model = toxicity.fit(docs, shifted)
    found = toxicity.score(docs, model).filter("doc_id < 1000 OR doc_id IS NULL").collect()
    assert len(found) == len(HARD) and not any(r["toxic"] for r in found)
    one_kind = spark.createDataFrame([(1000, 1, 0)], schema)
    assert toxicity.fit(docs, one_kind) is None and toxicity.fit(docs, one_kind.limit(0)) is None
    assert {r["severity"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        toxicity.score(docs.withColumn("TOXIC", F.lit(1)), None)
    named = docs.withColumn("_judged", F.lit("x")).withColumn("a.b", F.lit("y"))
    rows = toxicity.score(named, model).collect()
    assert len(rows) == docs.count() and all(r["_judged"] == "x" and r["a.b"] == "y" for r in rows)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_patterns_by_definition():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("a.@1+9- %2é") for _ in range(rng.randint(0, 24)))
        assert [m.span() for m in EMAIL.finditer(text)] == list(pii.emails(text))
        assert [m.span() for m in IP.finditer(text)] == [m.span() for m in pii.IP.finditer(text)]
    text = "x 4111 1111 1111 1111 y 1.2.3.4 z 300.1.1.1 a@b.c +1 (988) 555-2485 x 4111111111111112"
    assert pii.listed(pii.base_spans(text)) == "card:2:21,ip:24:31,email:44:49,phone:50:67"


def test_gradient_by_differences():
    model = pii.Tagger.fresh(1)
    model.p = {name: value.astype(np.float64) for name, value in model.p.items()}
    rng = np.random.default_rng(0)
    ids, tags = rng.integers(1, 99, (3, 7)), rng.integers(0, pii.TAGS, (3, 7))

    def loss():
        scores, _ = model.emissions(ids)
        moves, ahead, rows = model.p["moves"], scores[0], np.arange(3)
        for t in range(1, 7):
            ahead = pii.log_sum(ahead[:, :, None] + moves, 1) + scores[t]
        own = sum(scores[t][rows, tags[:, t]] for t in range(7)) + sum(moves[tags[:, t - 1], tags[:, t]] for t in range(1, 7))
        return (pii.log_sum(ahead, 1) - own).mean()

    for name, gradient in model.gradient(ids, tags).items():
        at = (int(ids[0, 0]), 3) if name == "embed" else tuple(rng.integers(0, n) for n in model.p[name].shape)
        kept = model.p[name][at]
        model.p[name][at] = kept + 1e-5
        high = loss()
        model.p[name][at] = kept - 1e-5
        low = loss()
        model.p[name][at] = kept
        assert gradient[at] == pytest.approx((high - low) / 2e-5, abs=1e-6)


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(5)
    texts = [invented(rng, "aa", 40) + " +1 (988) 555-2485 " + invented(rng, "bb", 30) for _ in range(60)]
    return pii.train(texts, count=800, epochs=6)


def test_windows_are_reconciled(tagger):
    tags = np.zeros(pii.WINDOW, dtype=np.int8)
    early, late = tags.copy(), tags.copy()
    early[90:96] = [7, 8, 8, 8, 8, 8]
    late[42:60] = [7] + [8] * 17
    assert pii.reconciled([(0, early), (pii.STRIDE, late)]) == [(90, 108, "phone")]
    assert pii.reconciled([(0, tags)]) == []
    rng = random.Random(6)
    found = 0
    for _ in range(40):
        before = invented(rng, "aa", rng.randint(1, 60))
        text = f"{before} (988) 555-2485 {invented(rng, 'aa', 20)}"
        spans = pii.added_spans([text], [pii.base_spans(text)], tagger)[0]
        found += any(text[a:b].endswith("555-2485") and kind == "phone" for a, b, kind in spans)
    assert found >= 30


def test_pii_table(corpus, tagger):
    docs = corpus([*HARD, (7, "mail a.b@c.de and 1.2.3.4, call (988) 555-2485 now")])
    found = {r["doc_id"]: r for r in pii.find(docs, tagger).collect()}
    row = found[7]
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 0, 0)
    assert row["base_sha256"] == hashlib.sha256(b"email:5:13,ip:18:25").hexdigest()
    assert row["spans"].startswith("email:5:13,ip:18:25")
    assert found[1]["spans"] == "" and found[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.find(docs, tagger).count() == len(HARD) + 1
    assert pii.find(docs.limit(0), tagger).count() == 0
    assert isinstance(pii.fit(docs.limit(0)), pii.Tagger)
    with pytest.raises(ValueError):
        pii.find(docs.withColumn("SPANS", F.lit(1)), tagger)


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 300_000 + "@") == []
    assert pii.base_spans("1" * 300_000 + " ") == []
    assert pii.base_spans("1." * 100_000) != []


def test_pii_sample_does_not_depend_on_repeats(corpus):
    rows = [(i, f"text {i} with 12{i}") for i in range(40)]
    once, often = corpus(rows), corpus(rows + [rows[3]] * 30)
    a, b = (pii.fit(docs, rows=5).p for docs in (once, once.repartition(7)))
    assert all(np.array_equal(a[k], b[k]) for k in a)
    assert pii.fit(often, rows=5) is not None


def test_pii_clashing_columns(corpus):
    docs = corpus([(1, "mail a@b.cd")]).withColumnRenamed("source", "_found").withColumnRenamed("lang", "found")
    found = pii.find(docs, pii.fit(docs))
    assert found.columns == [*docs.columns, *pii.OUTPUTS] and found.first()["_found"] == "src"
