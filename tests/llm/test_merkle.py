"""Merkle manifest: logs, positions, proofs and roots against a tree that is built level by level."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle
from tests.llm.conftest import HARD

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_levels(leaves):
    """All levels of a tree, from the leaves to the root."""
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[i : i + 2])) for i in range(0, len(row), 2)])
    return levels


def brute_leaf(row):
    return sha("".join("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def brute_proof(levels, index):
    """(siblings from the leaf to the root, steps)."""
    siblings, steps = [], []
    for row in levels[:-1]:
        other = index ^ 1
        siblings += [row[other]] if other < len(row) else []
        steps.append((("L" if other < index else "R") + row[other]) if other < len(row) else "-")
        index //= 2
    return siblings, steps


@pytest.mark.parametrize("n", [*range(1, 34), 63, 64, 65, 100])
def test_log_positions_and_proofs(n):
    leaves = [sha(str(i)) for i in range(n)]
    levels = brute_levels(leaves)
    log = merkle.append_log(leaves, merkle.height(n))
    assert len(log) == sum(map(len, levels)) and log[-1] == levels[-1][0]
    for k, row in enumerate(levels):
        for i, node in enumerate(row):
            assert log[merkle.position(n, k, i)] == node
    for i in range(n):
        steps = merkle.proof(log, n, merkle.height(n), i)
        assert steps == brute_proof(levels, i)[1]
        assert merkle.folded(leaves[i], steps) == levels[-1][0]
        assert merkle.proof_digest(steps) == sha("".join(brute_proof(levels, i)[0]))


def brute_audit(rows, tampered):
    """One (doc_id, leaf, subroot, root, proof, folded, verified) per row."""
    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, brute_leaf(row), row))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    levels = {}
    for lang in names:
        trees[lang].sort(key=lambda t: t[:3])
        levels[lang] = brute_levels([t[2] for t in trees[lang]])
    top = brute_levels([levels[lang][-1][0] for lang in names])
    root, found = top[-1][0], []
    for place, lang in enumerate(names):
        for i, (_, _, leaf, row) in enumerate(trees[lang]):
            siblings, steps = brute_proof(levels[lang], i)
            above, further = brute_proof(top, place)
            changed = dict(row) | {"n_chars": row["n_chars"] + 1} if tampered(row) and row["n_chars"] is not None else row
            node = merkle.folded(brute_leaf(changed), steps + further)
            found.append((row["doc_id"], leaf, levels[lang][-1][0], root, sha("".join(siblings + above)), node, node == root))
    return sorted(found, key=repr)


def audited(docs, levels):
    odd = F.col("doc_id") % 3 == 0
    shown = {"n_chars": F.when(odd, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    rows = merkle.audit(docs, FIELDS, "lang", "doc_id", shown, levels=levels).collect()
    return sorted([tuple(r) for r in rows], key=repr)


@pytest.mark.parametrize("levels", [2, 3, 10])
def test_audit_by_brute_force(spark, levels):
    rng = random.Random(levels)
    rows = []
    for i in range(150):
        lang = rng.choice(["en", "en", "en", "de", None, "é", "zz", ""])
        rows.append((i, None if i % 11 == 0 else f"text {i} é" * rng.randint(0, 5), lang, None if i % 7 == 0 else "src", None if i % 5 == 0 else i * 3))
    rows += [(None, "no id", "en", "src", 5), (4, "again", "en", "src", 5), (4, "again", "en", "src", 5), (9, "a hot one", "de", None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    want = brute_audit([r.asDict() for r in docs.collect()], lambda r: r["doc_id"] is not None and r["doc_id"] % 3 == 0)
    got = audited(docs, levels)
    assert got == want
    assert {r[6] for r in got} == {True, False}


def test_proofs_and_log_of_a_manifest(corpus):
    docs = corpus([(i, f"t{i}", "en" if i % 4 else "de") for i in range(37)])
    manifest = merkle.build_manifest(docs, FIELDS, "lang", "doc_id", levels=2)
    root = manifest.root().first()["root"]
    proofs = manifest.proofs().collect()
    assert len(proofs) == 37 and all(merkle.folded(r["digest"], r["path"]) == root for r in proofs)
    roots = {r["tree"]: r["subroot"] for r in manifest.subroots().collect()}
    logs = {}
    for r in manifest.log_entries().collect():
        logs.setdefault(r["tree"], {})[r["position"]] = r["digest"]
    leaves = {t: [r["digest"] for r in sorted(proofs, key=lambda r: r["idx"]) if r["tree"] == t] for t in roots}
    for tree, log in logs.items():
        whole = merkle.append_log(leaves[tree], merkle.height(len(leaves[tree])))
        assert [log[k] for k in range(len(log))] == whole and whole[-1] == roots[tree]


def test_hard_cases(corpus, spark):
    docs = corpus(HARD)
    rows = audited(docs, 2)
    assert len(rows) == len(HARD)
    assert rows == brute_audit([r.asDict() for r in docs.collect()], lambda r: r["doc_id"] is not None and r["doc_id"] % 3 == 0)
    assert merkle.audit(docs.limit(0), FIELDS, "lang", "doc_id").count() == 0
    one = merkle.audit(docs.filter("doc_id = 1"), FIELDS, "lang", "doc_id").first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["verified"] and one["proof_sha256"] == sha("")
    clashing = docs.withColumns({"idx": F.lit(1), "digest": F.lit("x"), "tree": F.lit("t"), "row": F.lit(0), "a.b": F.lit(2)})
    assert sorted(map(repr, merkle.audit(clashing, FIELDS, "lang", "doc_id").collect())) == sorted(map(repr, merkle.audit(docs, FIELDS, "lang", "doc_id").collect()))
    assert merkle.audit(clashing, ("doc_id", "a.b"), "lang", "doc_id").count() == len(HARD)
