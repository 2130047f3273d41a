"""URL filter and decontamination against brute force, and the pipeline's stages."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import decontamination, url_filter
from millrace.llm.queries import RULES
from tests.llm.conftest import HARD


def judged(spark, pages, links=None):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    table = None if links is None else spark.createDataFrame(links, "url string, target string")
    return {r["page_id"]: r for r in url_filter.judge_pages(df, RULES, table).collect()}


def test_rules(spark):
    urls = {
        1: ("http://a.Example.NET/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
        2: ("http://example.net/fr/1?q#f", "example.net", "/fr/1", "net/", "block"),
        3: ("https://x.example.com/de/", "x.example.com", "/de/", "example.com/de/", "block"),
        4: ("https://x.example.com/den", "x.example.com", "/den", None, "allow"),
        5: ("https://any.org/fr/x", "any.org", "/fr/x", "org/fr/", "allow"),
        6: ("http://example.net?x", "example.net", "", None, "allow"),
        7: ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        8: ("nothing", "", "", None, "allow"),
        9: (None, "", "", None, "allow"),
        10: ("a://b://c.net/", "b:", "//c.net/", None, "allow"),
        11: ("http://ÄB.NET/\n?x", "Äb.net", "/\n", "net/", "block"),
    }
    rows = judged(spark, [(i, u[0], None) for i, u in urls.items()])
    for i, (_, *want) in urls.items():
        assert [rows[i][c] for c in ("host", "path", "rule", "verdict")] == want, i


def test_blocks_spread_to_aliases(spark):
    canonical = '<head><link rel="canonical" href="{}"></head>'
    pages = [
        (1, "http://a.org/x", canonical.format("http://bad.net/y")),
        (2, "http://b.org/x", '<META http-equiv=refresh content="0; url=/z?a=1&amp;b=2">'),
        (3, "https://b.org/z?a=1&b=2", canonical.format("//a.org/x#top")),
        (4, "http://c.org/fr/x", canonical.format("http://bad.net/y")),
        (5, "http://d.org/x", canonical.format("/self")),
        (6, "http://www.c.org/x", canonical.format("http://c.org/fr/x")),
        (7, "http://e.org/dir/x", canonical.format("y")),
        (7, "http://e.org/dir/x", canonical.format("y")),
    ]
    rows = judged(spark, pages)
    assert {i: r["verdict"] for i, r in rows.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "allow"}
    assert rows[1]["rule"] is None and rows[4]["rule"] == "org/fr/" and rows[7]["alias_of"] == "//e.org/dir/x"
    assert judged(spark, pages, [("http://a.org/x", None), (None, "http://a.org/x")])[1]["verdict"] == "allow"
    empty = spark.createDataFrame(pages, "page_id long, url string, html string").limit(0)
    assert url_filter.judge_pages(empty, RULES).count() == 0


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5))) for _ in range(words)) + "."


def test_wand_by_brute_force():
    rng = random.Random(1)
    items = [decontamination.make_item(k, prose(rng, rng.randint(3, 30))) for k in range(60)]
    shards = decontamination.build_shards(items, shard_items=25)
    assert sorted(item.number for shard in shards for item in shard.items) == list(range(60))
    for _ in range(50):
        words = prose(rng, 40).split() + rng.choice(items).terms
        for shard in shards:
            numbers = {shard.vocabulary[w] for w in words if w in shard.vocabulary}
            for block, postings in enumerate(shard.postings):
                exact = {}
                for n in numbers & postings.keys():
                    for place, share in zip(*postings[n]):
                        exact[place] = exact.get(place, 0) + share
                        assert share <= shard.maxima[n, block] + 1e-6
                lists = [postings[n] for n in numbers if n in postings]
                found = dict(decontamination.wand(lists, 0.4))
                assert found == pytest.approx({p: s for p, s in exact.items() if s >= 0.4})


def test_leaks(spark, corpus):
    rng = random.Random(2)
    items = [(k, prose(rng, rng.randint(20, 40)) + " " + prose(rng, 8)) for k in range(30)] + [(90, None), (91, ""), (92, "!!!")]
    docs = [(i, prose(rng, rng.randint(5, 400))) for i in range(40)]
    for k in range(10):
        i, text = docs[k]
        words = text.split()
        words[len(words) // 2 : len(words) // 2] = items[k][1].upper().split()
        docs[k] = (i, " ".join(words))
    docs.append((50, items[3][1].split(".")[0]))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated(corpus([*docs, *[(60 + k, r[1]) for k, r in enumerate(HARD)]]), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(k, k) for k in range(10)}
    assert all(r["score"] == pytest.approx(1, abs=1e-6) and r["question_overlap"] == 1 for r in found)
    kept = decontamination.without_leaks(corpus(docs), benchmark)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs if i >= 10}
    assert decontamination.contaminated(corpus(docs), benchmark.limit(0)).count() == 0
    assert decontamination.contaminated(corpus(HARD).limit(0), benchmark).count() == 0
    assert decontamination.without_leaks(corpus(HARD), benchmark).count() == len(HARD)


def test_scans_are_bounded():
    rng = random.Random(3)
    shards = decontamination.build_shards([decontamination.make_item(k, prose(rng, 20)) for k in range(100)], shard_items=10)
    groups = decontamination.scans(shards, cells=3 * max(s.maxima.size for s in shards))
    assert len(groups) > 1 and sum(map(len, groups)) == len(shards)


def test_pipeline_stages(spark, corpus, tmp_path):
    rng = random.Random(4)
    leak, copied = prose(rng, 30), prose(rng, 60)
    docs = [(i, f"{prose(rng, 60)}\n{prose(rng, 40)}") for i in range(60)]
    docs[10] = (10, docs[10][1] + "\n" + copied)
    docs[11] = (11, copied + "\n" + docs[11][1])
    docs[12] = (12, docs[5][1])
    docs[13] = (13, docs[13][1] + " " + leak)
    for i in range(20, 40):
        docs[i] = (i, docs[i][1] + " zzgrumpzz")
    labels = [(i, 1, int(20 <= i < 40)) for i in range(60) if i not in (25, 26)]
    corpus(docs).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) == set(range(60)) - set(range(20, 40)) - {12, 13}
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    deduped = corpus_pipeline.fuzzy_line_dedup(spark, frame, str(tmp_path))
    assert deduped.columns == frame.columns
    rows = {r["doc_id"]: r for r in deduped.collect()}
    assert rows[11]["text"] == docs[11][1].split("\n", 1)[1] and rows[11]["n_chars"] == len(rows[11]["text"])
    none = corpus_pipeline.toxicity_filter(spark, frame.limit(0), str(tmp_path))
    assert none.count() == 0 and none.columns == frame.columns


def test_pipeline_keeps_further_columns(spark, corpus, tmp_path):
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "x")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = corpus(HARD).withColumn("key", F.lit(1)).withColumn("pos", F.lit("p"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[-2:] == ["key", "pos"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0
