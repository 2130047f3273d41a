"""The registered queries: SQL of the URL filter on pages with links, and contracts on the smallest tables."""

import os
import zlib

import duckdb
import pytest

from millrace.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_url_filter_sql(spark, tmp_path):
    link = '<link rel="canonical" href="{}">'
    pages = [
        (1, "http://a.org/x", link.format("http://bad.net/y")), (2, "http://b.org/x", '<meta http-equiv=refresh content="0; url=/z?a=1&amp;b=2">'),
        (3, "https://B.org/z?a=1&b=2", link.format("//a.org/x#top")), (4, "http://c.org/fr/x", link.format("http://bad.net/y")),
        (5, "http://d.org/x", link.format("self")), (6, None, link.format("http://bad.net/y")), (7, "none", None), (8, "http://k.net/q", None),
    ]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in QUERIES["op1_url_filter"](spark, str(tmp_path)).collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = db.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op1_url_filter']}) ORDER BY 1").fetchall()
    assert got == want and [r[4] for r in got] == ["block", "block", "block", "allow", "allow", "allow", "allow", "block"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_per_document(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    if name == "op2_decontamination":
        assert {(r["doc_id"], r["item_id"]) for r in rows}
        return
    key = {"op1_url_filter": "page_id", "op12_whitening": "vec_id"}.get(name, "doc_id")
    ids = [r[key] for r in rows if name != "op12_whitening" or r["component"] == 1]
    table = {"page_id": "pages", "vec_id": "embeddings"}.get(key, "documents")
    assert sorted(ids) == [r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).orderBy(key).collect()]
    if name == "op4_language_id":
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
