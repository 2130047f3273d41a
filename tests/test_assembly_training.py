from datetime import date, datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from millrace import operators as op


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_session_over_midnight(spark):
    start = datetime(2024, 1, 1, 23, 59, 50)
    data = [("p", "s", start + timedelta(seconds=2 * i), 1.0 + i) for i in range(20)] + [("q", "t", start, 3.0)]
    df = frame(spark, data, "pid STRING, sid STRING, ts TIMESTAMP_NTZ, v DOUBLE")
    args = (df, ["pid", "sid"], "ts", {"m": "v"}, {"cv": "v"}, "n")
    whole = {r.pid: r for r in op.session_features(*args).collect()}
    assert len(whole) == 2 and whole["p"].n == 20 and whole["p"].session_date == date(2024, 1, 1)
    assert whole["q"].cv is None
    values = pd.Series([1.0 + i for i in range(20)])
    assert abs(whole["p"].cv - values.std() / values.mean()) < 1e-12
    split = op.session_features(*args, split_by_date=True).filter("pid = 'p'").collect()
    assert sorted(r.n for r in split) == [5, 15]


def test_zero_mean_has_no_variation(spark):
    df = frame(spark, [("p", datetime(2024, 1, 1), -1.0), ("p", datetime(2024, 1, 1), 1.0)], "p STRING, ts TIMESTAMP_NTZ, v DOUBLE")
    assert op.session_features(df, ["p"], "ts", {}, {"cv": "v"}).first().cv is None


def waiting_room(spark):
    base = frame(
        spark,
        [("a", date(2024, 1, 1)), ("b", date(2024, 1, 1)), ("c", date(2024, 1, 9)), ("d", date(2024, 1, 10)), (None, date(2024, 1, 1)),
         ("e", date(2024, 1, 1)), ("e", date(2024, 1, 10))],
        "pid STRING, arrived DATE",
    )
    x = frame(spark, [("a", 1), ("b", 2), ("d", 4), ("d", 5), ("z", 9)], "pid STRING, x INT")
    y = frame(spark, [("a", 1), ("d", 3), (None, 7)], "pid STRING, y INT")
    return base, {"x": x, "y": y}


def test_complete_and_assemble(spark):
    base, sides = waiting_room(spark)
    assert sorted(r.pid for r in op.complete_ids({"base": base, **sides}, ["pid"]).collect()) == ["a", "d"]
    rows = op.assemble(base, sides, ["pid"]).drop("assembly_timestamp").collect()
    assert sorted(tuple(r) for r in rows) == [("a", date(2024, 1, 1), 1, 1), ("d", date(2024, 1, 10), 5, 3)]
    every = op.assemble(base, sides, ["pid"], combinations=True).drop("assembly_timestamp").collect()
    assert sorted(tuple(r) for r in every) == [
        ("a", date(2024, 1, 1), 1, 1),
        ("d", date(2024, 1, 10), 4, 3),
        ("d", date(2024, 1, 10), 5, 3),
    ]
    timed = {"x": sides["x"].withColumn("at", -F.col("x")), "y": sides["y"]}
    first = op.assemble(base, timed, ["pid"], ["at"], latest={"x": "x"}).drop("assembly_timestamp")
    assert sorted(tuple(r) for r in first.collect()) == sorted(tuple(r) for r in rows)
    earliest = op.assemble(base, timed, ["pid"], latest={"x": "at"})
    assert {r.pid: r.x for r in earliest.collect()} == {"a": 1, "d": 4}
    bare = op.assemble(base.select("pid"), {"x": sides["x"].select("pid")}, ["pid"])
    assert sorted(r.pid for r in bare.collect()) == ["a", "b", "d"]
    already = frame(spark, [("a",)], "pid STRING")
    assert {r.pid for r in op.assemble(base, sides, ["pid"], already=already).collect()} == {"d"}


def test_assembly_is_one_shuffle_and_one_scan_of_each_input(spark, tmp_path):
    base, sides = waiting_room(spark)
    for name, df in {"base": base, **sides}.items():
        df.write.parquet(str(tmp_path / name))
    read = {name: spark.read.parquet(str(tmp_path / name)) for name in ("base", *sides)}
    plan = op.assemble(read["base"], {k: read[k] for k in sides}, ["pid"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 3 and "Join" not in plan


def test_assembly_of_one_tagged_table(spark):
    rows = [("a", "x", 1), ("a", "x", 2), ("a", "y", 5), ("b", "x", 3), ("c", "y", 4), (None, "x", 1), (None, "y", 1), ("a", "z", 9), ("d", "x", None), ("d", "y", 1)]
    df = frame(spark, rows, "k STRING, kind STRING, v INT")
    sources = {"x": {"sum_x": (F.sum, "v"), "n_x": (F.count, "kind")}, "y": {"max_y": (F.max, "v")}}
    got = op.assemble_tagged(df, ["k"], "kind", sources).drop("assembly_timestamp")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 3, 2, 5), ("d", None, 1, 1)]
    done = op.complete_tagged(df.filter("k = 'a'"), ["k"], "kind", ["x", "y"])
    assert [r.k for r in op.assemble_tagged(df, ["k"], "kind", sources, done).collect()] == ["d"]


def test_presence_is_one_shuffle(spark):
    base, sides = waiting_room(spark)
    plan = op.complete_ids({"base": base, **sides}, ["pid"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_overdue(spark):
    base, sides = waiting_room(spark)
    got = op.overdue_incomplete(base, sides, ["pid"], "arrived", 3).drop("quarantine_timestamp").collect()
    # 'e' is overdue by its first row; all its rows wait together. 'c' is still within its time.
    assert sorted(tuple(r) for r in got) == [
        ("b", date(2024, 1, 1), False, True),
        ("e", date(2024, 1, 1), True, True),
        ("e", date(2024, 1, 10), True, True),
    ]
    already = frame(spark, [("b",)], "pid STRING")
    rest = op.overdue_incomplete(base, sides, ["pid"], "arrived", 3, already)
    assert {r.pid for r in rest.collect()} == {"e"}


def test_overdue_of_nothing(spark):
    base, sides = waiting_room(spark)
    assert op.overdue_incomplete(base.filter("pid = 'none'"), sides, ["pid"], "arrived", 3).isEmpty()


def test_fan_out_report(spark):
    base, sides = waiting_room(spark)
    report = {r.source: (r.n_rows, r.n_ids, r.max_rows_per_id) for r in op.fan_out_report({"base": base, **sides}, ["pid"]).collect()}
    assert report == {"base": (6, 5, 2), "x": (5, 4, 2), "y": (2, 2, 1)}


def test_training_table_drops_leaky_labels_and_keeps_rows(spark):
    base = frame(spark, [("a", date(2024, 1, 1)), ("b", date(2024, 1, 1)), ("c", date(2024, 1, 1))], "pid STRING, snapshot_date DATE")
    side = frame(spark, [("a", 1.5, "f")], "pid STRING, x DOUBLE, source_file STRING")
    labels = frame(
        spark,
        [("a", date(2024, 1, 1), date(2024, 1, 2), 1), ("b", date(2024, 1, 1), date(2024, 1, 1), 1)],
        "pid STRING, snapshot_date DATE, label_available_date DATE, y INT",
    )
    table = op.training_table(base, {"s": side}, labels, ["pid"], ["source_file"])
    assert table.columns == ["pid", "snapshot_date", "x", "label_available_date", "y"]
    assert {r.pid: (r.x, r.y) for r in table.collect()} == {"a": (1.5, 1), "b": (None, None), "c": (None, None)}
    assert op.antileakage(labels.drop("label_available_date"), "label_available_date", "snapshot_date").count() == 2


def test_repeat_ids_multiply(spark):
    base = frame(spark, [("a", date(2024, 1, 1)), ("a", date(2024, 2, 1))], "pid STRING, snapshot_date DATE")
    side = frame(spark, [("a", 1), ("a", 2)], "pid STRING, x INT")
    labels = frame(spark, [], "pid STRING, snapshot_date DATE, label_available_date DATE, y INT")
    assert op.training_table(base, {"s": side}, labels, ["pid"]).count() == 4
    single = op.training_table(base, {"s": side}, labels, ["pid"], latest={"s": "x"})
    assert [r.x for r in single.collect()] == [2, 2]


def test_repeat_ids_get_no_label_of_another_date(spark):
    days = [date(2024, 1, 1), date(2024, 6, 1)]
    base = frame(spark, [("a", day) for day in days], "pid STRING, snapshot_date DATE")
    labels = frame(spark, [("a", days[0], date(2024, 2, 1), 1)], "pid STRING, snapshot_date DATE, label_available_date DATE, y INT")
    for rows in (op.training_table(base, {}, labels, ["pid"]), op.training_table(base, {}, labels.drop("snapshot_date"), ["pid"])):
        assert {r.snapshot_date: r.y for r in rows.collect()} == {days[0]: 1, days[1]: None}


def test_cutoffs_match_pandas(spark):
    days = [date(2024, 1, 1) + timedelta(days=(i * i) % 37) for i in range(101)]
    df = frame(spark, [(d,) for d in days] + [(None,)], "d DATE")
    series = pd.to_datetime(pd.Series(days)).astype("int64")
    unit = {"datetime64[ns]": 1, "datetime64[us]": 1_000, "datetime64[s]": 10**9}[str(pd.to_datetime(pd.Series(days)).dtype)]
    want = [pd.Timestamp(int(round(series.quantile(q) * unit))).date() for q in (0.7, 0.9)]
    assert op.cutoff_dates(df, "d") == want
    split = op.temporal_split(df, "d")
    counts = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts["train"] == sum(d <= want[0] for d in days)
    assert counts["test"] == sum(d > want[1] for d in days)
    assert sum(counts.values()) == 102 and counts[None] == 1


def test_cutoff_on_midnight_is_not_moved_by_float_noise(spark):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(11)]
    df = frame(spark, [(d,) for d in days], "d DATE")
    assert op.cutoff_dates(df, "d") == [date(2024, 1, 8), date(2024, 1, 10)]


def test_no_dates_no_split(spark):
    df = frame(spark, [(None,)], "d DATE")
    assert op.temporal_split(df, "d").first().split is None


def test_label_coverage_and_summary(spark):
    df = frame(spark, [(date(2024, 1, 1), 1, "train"), (date(2024, 1, 2), 0, "train"), (date(2024, 1, 3), None, None)], "d DATE, y INT, split STRING")
    assert tuple(op.label_coverage(df, "y").first()) == (2, 1)
    assert op.labeled_only(df, "y").count() == 2
    row = op.split_summary(df, "d", "y").first()
    assert (row.split, row.n, row.min_date, row.max_date, row.prevalence) == ("train", 2, date(2024, 1, 1), date(2024, 1, 2), 0.5)


def test_arrival_cutoff_is_a_subquery_not_a_join(spark):
    base, sides = waiting_room(spark)
    plan = op.overdue_incomplete(base, sides, ["pid"], "arrived", 3)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "subquery" in plan.lower()
