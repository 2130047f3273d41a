import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.sources import ParquetTable, TableMissing


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedup_keeps_latest_and_is_deterministic(spark):
    data = [(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, None, "d"), (2, 0, "e")]
    for _ in range(3):
        random.shuffle(data)
        df = spark.createDataFrame(data, "k INT, ts INT, v STRING").repartition(3)
        assert rows(op.dedup_latest(df, ["k"], "ts")) == [(1, 2, "c"), (2, 0, "e")]


def test_dedup_keeps_all_rows_without_key(spark):
    df = spark.sql("SELECT * FROM VALUES (NULL, 1), (NULL, 1), (3, 1), (3, 2) t(k, ts)")
    got = op.dedup_latest(df, ["k"], "ts").collect()
    assert len(got) == 3 and sum(r.k is None for r in got) == 2


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = op.dedup_latest(df, ["k"], "ts")._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
    assert final < plan.index("Exchange hashpartitioning(k") < partial


def test_upsert_updates_inserts_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep"), (None, "n")], "k INT, v STRING")
    source = spark.createDataFrame([(1, "new"), (3, "ins")], "k INT, v STRING")
    once = op.upsert(target, source, ["k"])
    want = {(1, "new"), (2, "keep"), (3, "ins"), (None, "n")}
    assert {tuple(r) for r in once.collect()} == want
    assert {tuple(r) for r in op.upsert(once, source, ["k"]).collect()} == want


def test_delete_matched_and_count(spark):
    target = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k INT")
    keys = spark.createDataFrame([(2,), (2,), (9,)], "k INT")
    assert rows(op.delete_matched(target, keys, ["k"])) == [(1,), (3,)]
    assert op.matched_count(target, keys, ["k"]).first().n == 2


def files(table):
    return sorted(r[0] for r in table.read().select("_metadata.file_path").distinct().collect())


def test_table_merge_equals_upsert(spark, tmp_path):
    rng = random.Random(3)
    table = ParquetTable(spark, str(tmp_path / "t"), {"month": "int"})
    expected = {}
    for tick in range(5):
        slice_ = {k: (k, rng.randint(1, 3), f"{tick}-{k}") for k in rng.sample(range(40), 12)}
        df = spark.createDataFrame(list(slice_.values()), "k INT, month INT, v STRING")
        for _ in range(1 + tick % 2):
            table.merge(df, ["k"])  # again changes nothing
        expected.update(slice_)
    assert rows(table.read().select("k", "month", "v")) == sorted(expected.values())
    assert len(files(table)) == 3


def test_merge_into_escaped_partitions(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), {"p": "string"})
    names = ["a:b", "x/y", "50%", "it's", "k=v", "[q]", "plain word", "01", "a+b", "é"]
    table.overwrite(spark.createDataFrame([(i, "old", p) for i, p in enumerate(names)], "k INT, v STRING, p STRING"))
    table.merge(spark.createDataFrame([(i, "new", p) for i, p in enumerate(names)], "k INT, v STRING, p STRING"), ["k"])
    assert rows(table.read().select("k", "v", "p")) == [(i, "new", p) for i, p in enumerate(names)]
    # Every key moves: what it leaves behind is empty.
    table.merge(spark.createDataFrame([(i, "moved", f"to {p}") for i, p in enumerate(names)], "k INT, v STRING, p STRING"), ["k"])
    assert rows(table.read().select("k", "v", "p")) == [(i, "moved", f"to {p}") for i, p in enumerate(names)]


def test_merge_leaves_other_partitions_alone(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), {"month": "int"})
    table.overwrite(spark.sql("SELECT id AS k, CAST(id AS INT) AS month FROM range(1, 4)"))
    before = files(table)
    table.merge(spark.sql("SELECT 2L AS k, 9 AS month"), ["k"])
    kept = [f for f in before if "month=2/" not in f]
    assert [f for f in files(table) if "month=9/" not in f] == kept
    assert rows(table.read()) == [(1, 1), (2, 9), (3, 3)]


def test_merge_adds_rows_to_partitions_without_a_key(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), {"month": "int"})
    table.overwrite(spark.sql("SELECT id AS k, 1 AS month, 'old' AS v FROM range(5)"))
    before = files(table)
    # New keys: what is there is not written again, and a repeated merge changes nothing.
    for _ in range(2):
        table.merge(spark.sql("SELECT id AS k, 1 AS month, 'new' AS v FROM range(5, 8)"), ["k"])
        assert rows(table.read().select("k", "v")) == [(k, "old" if k < 5 else "new") for k in range(8)]
        if _ == 0:
            assert set(before) < set(files(table))
    # A key that moves leaves its partition; a later row wins over one that is added elsewhere.
    table.merge(spark.sql("SELECT * FROM VALUES (0, 2, 'moved'), (9, 2, 'more') t(k, month, v)").withColumn("k", F.col("k").cast("long")), ["k"])
    assert rows(table.read().filter("month = 2").select("k", "v")) == [(0, "moved"), (9, "more")]
    assert rows(table.read().select("k")) == [(k,) for k in [*range(8), 9]]


def test_many_merges_leave_few_files(spark, tmp_path, monkeypatch):
    from millrace.sources import tables

    monkeypatch.setattr(tables, "MOST_SMALL", 3)
    table = ParquetTable(spark, str(tmp_path / "t"), {"month": "int"})
    for k in range(8):
        table.merge(spark.sql(f"SELECT {k}L AS k, 1 AS month"), ["k"])
        assert len(files(table)) <= 3
    assert rows(table.read().select("k")) == [(k,) for k in range(8)]


def test_merge_keeps_the_latest_over_partitions_that_get_rows(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), {"month": "int"})
    table.overwrite(spark.sql("SELECT * FROM VALUES (1, 5, 1), (2, 5, 1) t(k, at, month)"))
    table.merge(spark.sql("SELECT * FROM VALUES (1, 4, 2), (2, 6, 3), (3, 1, 2) t(k, at, month)"), ["k"], "at", op.dedup_latest)
    assert rows(table.read()) == [(1, 5, 1), (2, 6, 3), (3, 1, 2)]


def test_merge_keeps_the_latest_on_request(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), {"month": "int"})
    table.overwrite(spark.sql("SELECT * FROM VALUES (1, 5, 1), (2, 5, 1), (3, 5, 2) t(k, at, month)"))
    table.merge(spark.sql("SELECT * FROM VALUES (1, 4, 3), (2, 6, 3), (4, 1, 2) t(k, at, month)"), ["k"], "at", op.dedup_latest)
    assert rows(table.read()) == [(1, 5, 1), (2, 6, 3), (3, 5, 2), (4, 1, 2)]


def test_missing_and_overwritten(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"))
    with pytest.raises(TableMissing):
        table.read()
    assert not table.exists()
    table.overwrite(spark.range(3))
    table.overwrite(spark.range(5))
    first = table.modified()
    assert table.read().count() == 5 and first > 0
    table.append(spark.range(1))
    assert table.read().count() == 6 and table.modified() >= first


def test_append_merges_schema_and_missing_table_has_full_schema(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"))
    schema = spark.sql("SELECT 1 AS a, 'x' AS b").schema
    assert table.read_or_empty(schema).columns == ["a", "b"] and table.read_or_empty(schema).isEmpty()
    table.append(spark.sql("SELECT 1 AS a"))
    table.append(spark.sql("SELECT 2 AS a, 'x' AS b"))
    assert sorted(tuple(r) for r in table.read().collect()) == [(1, None), (2, "x")]
    with pytest.raises(ValueError, match="column 'a'"):
        table.append(spark.sql("SELECT 'text' AS a"))


def test_empty_and_null_partitions(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), {"year": "int"})
    table.overwrite(spark.sql("SELECT 1 AS k, 2024 AS year LIMIT 0"))
    table.merge(spark.sql("SELECT * FROM VALUES (1, NULL), (2, 2024) t(k, year)"), ["k"])
    table.merge(spark.sql("SELECT * FROM VALUES (1, 2025) t(k, year)"), ["k"])
    assert rows(table.read()) == [(1, 2025), (2, 2024)]
    table.merge(spark.sql("SELECT * FROM VALUES (CAST(NULL AS INT), 2025) t(k, year)"), ["k"])
    assert table.read().count() == 3


def test_delete_from_table(spark, tmp_path):
    for name, parts in (("plain", {}), ("parted", {"p": "long"})):
        table = ParquetTable(spark, str(tmp_path / name), parts)
        table.overwrite(spark.range(5).withColumn("p", F.col("id") % 2))
        before = files(table)
        table.delete(spark.range(50, 60), ["id"])
        assert files(table) == before
        table.delete(spark.range(2), ["id"])
        assert [r[0] for r in rows(table.read())] == [2, 3, 4]
        table.delete(spark.createDataFrame([(2,), (4,)], "id LONG"), ["id"])
        assert rows(table.read()) == [(3, 1)]


def test_replace_partitions(spark, tmp_path):
    table = ParquetTable(spark, str(tmp_path / "t"), {"ok": "boolean", "month": "int"})
    table.overwrite(spark.sql("SELECT * FROM VALUES (1, true, 1), (2, false, 1), (3, true, 2) t(k, ok, month)"))
    table.replace(spark.sql("SELECT * FROM VALUES (1, true, 1), (2, true, 1) t(k, ok, month)"), F.col("month") == 1)
    assert rows(table.read()) == [(1, True, 1), (2, True, 1), (3, True, 2)]


def test_overwriting_does_not_collect_files(spark, tmp_path):
    """Many watermarks leave as many files as one."""
    from millrace.plans import ingest
    from millrace.plans.store import Store

    store, counts = Store(spark, str(tmp_path)), set()
    for k in range(10):
        ingest.write_watermark(store, "feed", datetime(2024, 1, 1, k % 24))
        counts.add(sum(len(names) for _, _, names in __import__("os").walk(tmp_path)))
    assert len(counts) == 1 and ingest.read_watermark(store, "feed") == datetime(2024, 1, 1, 9)


def test_left_join_all_keeps_base_rows(spark):
    base = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (NULL, 'c') t(k, v)")
    one = spark.sql("SELECT * FROM VALUES (1, 10), (1, 11), (NULL, 12) t(k, x)")
    two = spark.sql("SELECT * FROM VALUES (2, 20) t(k, y)")
    got = {tuple(r) for r in op.left_join_all(base, [one, two], ["k"]).collect()}
    assert got == {(1, "a", 10, None), (1, "a", 11, None), (2, "b", None, 20), (None, "c", None, None)}


def test_hot_key_of_a_left_join_is_split(spark):
    """One key holds a third of the base: adaptive execution must read its partition in pieces."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))
        base = spark.range(0, 60_000, 1, 8).select(hot.alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        sides = [spark.range(0, 60_000, 1, 4).select(F.col("id").alias("k"), (F.col("id") * i).alias(f"x{i}")) for i in (2, 3)]
        joined = op.left_join_all(base, sides, ["k"])
        execution = joined._jdf.queryExecution()
        assert execution.toRdd().count() == 60_000
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_window_bounds(spark):
    times = [datetime(2024, 1, 1, h) for h in range(5)]
    df = spark.createDataFrame([(t,) for t in times], "ts TIMESTAMP_NTZ")
    got = op.window_slice(df, "ts", times[1], times[3]).collect()
    assert sorted(r.ts for r in got) == times[2:4]
    assert op.window_slice(df, "ts", times[3], None).count() == 1
    assert op.window_slice(df, "ts", None, times[1]).count() == 2
    assert op.first_tick(df, "ts").first() == (5, times[-1])


def test_replay_matches_window_slices(spark):
    from datetime import timedelta

    rng = random.Random(5)
    start, width = datetime(2024, 1, 1), timedelta(minutes=7)
    times = [start + timedelta(seconds=rng.randint(0, 9000)) for _ in range(40)] + [start + width, start + 2 * width]
    df = spark.createDataFrame([(t,) for t in times], "ts TIMESTAMP_NTZ")
    replay = op.replay_windows(df, "ts", start, width).orderBy("tick").collect()
    for r in replay:
        assert r.n_rows == sum(r.window_start < t <= r.window_end for t in times)
    assert [r.tick for r in replay] == list(range(len(replay)))
    assert sum(r.n_rows for r in replay) == sum(t > start for t in times)


def test_late_rows(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 3)), ("b", None)], "s STRING, ts TIMESTAMP_NTZ")
    mark = datetime(2024, 1, 1)
    assert sorted(r.s for r in op.late_rows(df, "ts", mark).collect()) == ["a", "b"]
    report = {r.s: (r.n_late, r.n_ahead) for r in op.late_report(df, "ts", mark, ["s"]).collect()}
    assert report == {"a": (1, 1), "b": (1, 0)}
