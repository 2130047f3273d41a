from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.functions import RuleBook, anti_join, business_columns, cast_columns, feature_columns, with_audit
from millrace.functions import with_partitions
from millrace.plans import clinical as c

RULES = {"valid_age": "age >= 65 AND age <= 100", "valid_sex": "sex IN ('M', 'F')"}


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, 70, "M"), (2, None, "M"), (3, None, "X"), (4, 150, "F"), (5, 20, "X")]
    return spark.createDataFrame(rows, "id INT, age INT, sex STRING")


def test_cast_turns_malformed_values_into_null(spark):
    df = spark.createDataFrame([("7", "abc"), (None, "1.5")], "a STRING, b STRING")
    rows = cast_columns(df, {"a": "INT", "b": "DOUBLE"}).collect()
    assert [tuple(r) for r in rows] == [(7, None), (None, 1.5)]


def test_cast_of_text_agrees_with_try_cast(spark):
    texts = ["7", " 8 ", "+9", "-3", "1.5", "1e3", "abc", "", " ", "99999999999", "--1", "\t4\n", "\x014", "0x1F", None, "٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", F.col("t").alias("n"), F.col("t").alias("b"))
    for r in cast_columns(df, {"n": "INT", "b": "long"}).select("*", F.expr("try_cast(t AS INT)"), F.expr("try_cast(t AS BIGINT)")).collect():
        assert (r.n, r.b) == (r[3], r[4]), r.t


def test_whole_decimals_are_integers(spark):
    texts = {"72.0": 72, "72.": 72, " -3.00 ": -3, "72.5": None, "7.0.0": None, ".0": None, "99999999999.0": None}
    df = spark.createDataFrame([(t, t) for t in texts], "t STRING, n STRING")
    assert {r.t: r.n for r in cast_columns(df, {"n": "INT"}).collect()} == texts


def test_cast_can_raise(spark):
    df = spark.createDataFrame([("abc",)], "a STRING")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cast_columns(df, {"a": "INT"}, on_error="raise").collect()
    with pytest.raises(ValueError, match="on_error"):
        cast_columns(df, {}, on_error="maybe")


def test_audit_and_partition_columns(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 31, 23, 59),), (None,)], "ts TIMESTAMP")
    rows = with_partitions(with_audit(df, "ts", datetime(2025, 1, 1)), "ts").orderBy("year").collect()
    assert (rows[0].year, rows[0].month, rows[0].sim_arrival_date) == (None, None, None)
    assert (rows[1].year, rows[1].month, str(rows[1].sim_arrival_date)) == (2024, 3, "2024-03-31")


def test_column_selection(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id INT, x INT, y INT")
    assert business_columns(df, {"id"}) == ["x", "y"]
    assert feature_columns(df, {"id"}, ["z"]) == ["x", "y"]
    with pytest.raises(ValueError, match="must not be model inputs"):
        feature_columns(df, {"id"}, ["y"])


def test_split_null_counts_as_failure(people):
    valid, quarantine = op.split_by_rules(people, RULES)
    assert [r.id for r in valid.collect()] == [1]
    failed = {r.id: r.failed_rules for r in quarantine.collect()}
    assert failed == {
        2: ["valid_age"],
        3: ["valid_age", "valid_sex"],
        4: ["valid_age"],
        5: ["valid_age", "valid_sex"],
    }
    assert valid.columns == people.columns
    assert op.check_conservation(people, valid, quarantine).first().is_conserved


def test_split_null_dropped_on_request(people):
    valid, quarantine = op.split_by_rules(people, RULES, "drop")
    assert [r.id for r in valid.collect()] == [1]
    assert {r.id: r.failed_rules for r in quarantine.collect()} == {
        3: ["valid_sex"],
        4: ["valid_age"],
        5: ["valid_age", "valid_sex"],
    }
    assert not op.check_conservation(people, valid, quarantine).first().is_conserved
    with pytest.raises(ValueError, match="null_policy"):
        op.split_by_rules(people, RULES, "keep")
    with pytest.raises(ValueError, match="no rules"):
        op.split_by_rules(people, {})


def test_tagging_agrees_with_split(people):
    tagged = {r.id: (r.is_valid, r.failed_rules) for r in op.tag_by_rules(people, RULES).collect()}
    assert tagged[1] == (True, [])
    assert tagged[3] == (False, ["valid_age", "valid_sex"])


def test_rule_report_and_checks(people):
    report = {r.rule: (r.n_rows, r.n_violations, r.n_undecided) for r in op.rule_report(people, RULES).collect()}
    assert report == {"valid_age": (5, 2, 2), "valid_sex": (5, 2, 0)}
    assert {r["column"]: r.n_null for r in op.check_not_null(people, ["id", "age"]).collect()} == {"id": 0, "age": 2}
    unique = op.check_unique(people, ["sex"]).first()
    assert (unique.n_rows, unique.n_keys, unique.n_repeated_keys, unique.is_unique) == (5, 3, 2, False)
    assert op.check_unique(people.filter("id > 9"), ["id"]).first().is_unique


def test_subset_check(spark):
    labels = spark.sql("SELECT * FROM VALUES (1), (1), (2), (9), (NULL) t(k)")
    clinical = spark.sql("SELECT * FROM VALUES (1), (2), (3), (3) t(k)")
    assert tuple(op.check_subset(labels, clinical, ["k"]).first()) == (4, 1, False)
    assert tuple(op.check_subset(clinical, clinical, ["k"]).first()) == (4, 0, True)
    assert op.check_subset(labels.limit(0), clinical, ["k"]).first().is_subset


def test_rule_book():
    book = RuleBook().add("a", "one", "x > 0")
    with pytest.raises(ValueError, match="already registered"):
        book.add("a", "one", "x > 1")
    with pytest.raises(ValueError, match="unknown tag"):
        book.rules_for("b")
    sizes = {tag: len(c.RULES.rules_for(tag)) for tag in c.RULES.tags}
    assert sizes == {"clinical": 16, "sppb": 7, "lifestyle": 8, "gait": 10, "labels": 5}


def test_label_on_the_snapshot_day_is_incoherent(spark):
    df = spark.sql("SELECT 'p' patient_id, date'2024-01-02' snapshot_date, date'2024-01-02' label_available_date, 1 frailty_label")
    _, quarantine = op.split_by_rules(df, c.RULES.rules_for("labels"))
    assert quarantine.first().failed_rules == ["temporal_coherence"]


def test_anti_join_keeps_null_keys(spark):
    left = spark.sql("SELECT * FROM VALUES (1, 'a'), (NULL, 'b'), (NULL, 'c'), (2, 'd') t(k, v)")
    right = spark.sql("SELECT * FROM VALUES (1), (NULL) t(k)")
    assert sorted(r.v for r in anti_join(left, right, ["k"]).collect()) == ["b", "c", "d"]


def test_input_of_an_anti_join_is_read_once(spark):
    left, right = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k")), spark.range(0, 3000, 2).select(F.col("id").alias("k"))
    plan = anti_join(left, right, ["k"])
    assert plan._jdf.queryExecution().executedPlan().toString().count("Range (0, 3000, step=1") == 1
    assert plan.count() == 1000 + 1000


def test_valid_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(100).select(F.col("id"), (F.col("id") % 7).alias("x"), F.lit("t").alias("wide")).write.parquet(path)
    valid, _ = op.split_by_rules(spark.read.parquet(path), {"small": "x <= 3"})
    plan = valid.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(x,3)" in plan and "wide" not in plan.split("ReadSchema")[1]
