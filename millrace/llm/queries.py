"""The corpus operators as queries over the test tables, with SQL where it can be written."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    decontamination,
    imatch,
    language_id,
    line_dedup,
    merkle,
    pii,
    secret_scan,
    simhash,
    token_files,
    toxicity,
    url_filter,
    whitening,
)
from millrace.llm.common import tuned_batches, with_package
from millrace.session import scratch_path, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(name: str, sql: str | None = None):
    """Register a query and, where there is one, its SQL."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(with_package(tuned_batches(tune(spark))), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


def _sql_host(url: str) -> str:
    return f"translate(coalesce(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), ''), '{url_filter.CAPITALS}', '{url_filter.SMALL}')"


def _sql_path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _sql_key(url: str) -> str:
    query = f"regexp_extract({url}, '(?s)^.*?://[^?#]*(\\?[^#]*)', 1)"
    return f"CASE WHEN contains({url}, '://') THEN '//' || {_sql_host(url)} || {_sql_path(url)} || {query} END"


def _sql_rule(field: str) -> str:
    order = sorted(RULES, key=lambda r: (-len(r.text), r.verdict != "allow", r.text))
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, field)}'" for r in order
    )
    return f"CASE {cases} END"


def _sql_target(tag: str, address: str) -> str:
    quoted = [pattern.replace("'", "''") for pattern in (tag, address)]
    return f"regexp_extract(regexp_extract(html, '{quoted[0]}'), '{quoted[1]}', 1)"


URL_FILTER_SQL = f"""
    WITH RECURSIVE named AS (
        SELECT url, replace(t, '&amp;', '&') AS t, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS site,
               regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)', 1) AS folder
        FROM (SELECT url, unnest([{_sql_target(*url_filter.CANONICAL)}, {_sql_target(*url_filter.REFRESH)}]) AS t FROM pages)
        WHERE t <> '' AND contains(url, '://')),
    resolved AS (
        SELECT url, CASE WHEN contains(t, '://') THEN t
                         WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?):', 1) || ':' || t
                         WHEN starts_with(t, '/') THEN site || t
                         ELSE folder || CASE WHEN ends_with(folder, '/') THEN '' ELSE '/' END || t END AS target FROM named),
    links AS (SELECT {_sql_key("url")} AS a, {_sql_key("target")} AS b FROM resolved),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
    members AS (SELECT a, {_sql_host("('x:' || b)")} AS host, {_sql_path("('x:' || b)")} AS path FROM reach),
    blocked AS (SELECT DISTINCT a FROM members WHERE {_sql_rule("verdict")} = 'block'),
    judged AS (SELECT page_id, {_sql_host("url")} AS host, {_sql_path("url")} AS path, {_sql_key("url")} AS k FROM pages)
    SELECT page_id, host, path, {_sql_rule("text")} AS rule,
           coalesce({_sql_rule("verdict")}, CASE WHEN a IS NULL THEN 'allow' ELSE 'block' END) AS verdict
    FROM judged LEFT JOIN blocked ON a = k
    """


@query("op1_url_filter", URL_FILTER_SQL)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_pages(table(spark, sf_dir, "pages"), RULES).drop("alias_of")


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_byte_bpe")
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digest_documents(docs, MULTI_RANKS, public_tokenizers.PATTERN)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language_id.fit(docs, ~held_out)
    found = language_id.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.drop("text")


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs.select("doc_id", "text"), model).drop("text")


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs)).drop("text")


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    token_files.write_shards(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=1)
    return token_files.read_documents(spark, path)


@query("op8_line_dedup")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


@query("op9_imatch")
def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.compare_with_edits(table(spark, sf_dir, "documents"))


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select(
        F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"), "n_links"
    )


LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _sql_leaf(**changed: str) -> str:
    texts = [f"CAST({changed.get(name, name)} AS VARCHAR)" for name in LEAF_FIELDS]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


# CRC-32 by bits: a byte is mixed in, then eight steps (marked 256) shift it out.
SQL_CRC = """xor(list_reduce(flatten([[4294967295]] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ascii(c) AS BIGINT), 256, 256, 256, 256, 256, 256, 256, 256])),
    lambda c, e: CASE WHEN e < 256 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295)"""
SQL_PARENT = "sha256(string_agg(digest, '' ORDER BY idx))"
SQL_FOLD = """sha256(CASE WHEN s.digest IS NULL THEN f.shown WHEN f.idx % 2 = 1 THEN s.digest || f.shown ELSE f.shown || s.digest END)"""

MERKLE_SQL = f"""
    WITH RECURSIVE shown AS (SELECT *, {SQL_CRC} % 7 = 0 AS tampered FROM documents),
    leaves AS (
        SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_sql_leaf()} AS leaf,
               CASE WHEN tampered THEN {_sql_leaf(n_chars="n_chars + 1")} ELSE {_sql_leaf()} END AS shown FROM shown),
    placed AS (
        SELECT row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS k, *, count(*) OVER (PARTITION BY tree) AS n,
               row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves),
    nodes AS (
        SELECT tree, 0 AS level, idx, leaf AS digest, n FROM placed
        UNION ALL
        SELECT tree, level + 1, idx // 2, {SQL_PARENT}, (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2, n),
    subroots AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
    tops AS (
        SELECT 0 AS level, idx, subroot AS digest, n FROM subroots
        UNION ALL
        SELECT level + 1, idx // 2, {SQL_PARENT}, (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY level, idx // 2, n),
    fold AS (
        SELECT k, tree, 0 AS level, idx, shown, '' AS siblings, n FROM placed
        UNION ALL
        SELECT f.k, f.tree, f.level + 1, f.idx // 2, {SQL_FOLD}, f.siblings || coalesce(s.digest, ''), (f.n + 1) // 2
        FROM fold f LEFT JOIN nodes s ON s.tree = f.tree AND s.level = f.level AND s.idx = xor(f.idx, 1) WHERE f.n > 1),
    rise AS (
        SELECT k, 0 AS level, r.idx, f.shown, f.siblings, r.n FROM fold f JOIN subroots r USING (tree) WHERE f.n = 1
        UNION ALL
        SELECT f.k, f.level + 1, f.idx // 2, {SQL_FOLD}, f.siblings || coalesce(s.digest, ''), (f.n + 1) // 2
        FROM rise f LEFT JOIN tops s ON s.level = f.level AND s.idx = xor(f.idx, 1) WHERE f.n > 1)
    SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, rise.shown AS folded_root, rise.shown = root AS verified
    FROM rise JOIN placed USING (k) JOIN subroots USING (tree), (SELECT digest AS root FROM tops WHERE n = 1)
    WHERE rise.n = 1
    """


@query("op11_merkle", MERKLE_SQL)
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    shown = {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    return merkle.audit(docs, LEAF_FIELDS, "lang", "doc_id", shown).withColumnRenamed("id", "doc_id")


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows, whitening.fit(rows))


@query("op13_secret_scan")
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.find(docs, secret_scan.fit(docs)).drop("text")
