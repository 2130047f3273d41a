import random

import pytest
from pyspark.sql import functions as F

from millrace import operators as op


def brute(left, right):
    """Per left row the greatest (time, value) of its id on or before it."""
    found = []
    for k, t, n in left:
        before = [(rt, v is not None, v) for rk, rt, v in right if k is not None and t is not None and rk == k and rt is not None and rt <= t]
        best = max(before, default=(None, None, None), key=lambda b: (b[0], b[1], b[2] or 0))
        found.append((k, t, n, best[0], best[2]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_asof_by_brute_force(spark, coalesce):
    rng = random.Random(1)
    # A third of all rows have one id, and times repeat.
    some = lambda: "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None, "only left"])
    left = [(some(), rng.choice([None, *range(60)]), n) for n in range(500)]
    right = [(k if (k := some()) != "only left" else "only right", rng.choice([None, *range(0, 60, 3)]), rng.choice([None, 1, 2, 3])) for _ in range(300)]
    a = spark.createDataFrame(left, "k STRING, t INT, n INT").repartition(5)
    b = spark.createDataFrame(right, "k STRING, rt INT, v INT").repartition(3)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        got = op.asof_join(a, b, ["k"], "t", "rt", ["rt", "v"])
        assert got.columns == ["k", "t", "n", "rt", "v"]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(left, right)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_asof_of_nothing(spark):
    a = spark.createDataFrame([("x", 1)], "k STRING, t INT")
    b = spark.createDataFrame([], "k STRING, rt INT, v INT")
    assert [tuple(r) for r in op.asof_join(a, b, ["k"], "t", "rt", ["v"]).collect()] == [("x", 1, None)]
    assert op.asof_join(a.limit(0), b, ["k"], "t", "rt", ["v"]).isEmpty()
    with pytest.raises(ValueError, match="both sides"):
        op.asof_join(a, b.withColumn("t", F.lit(1)), ["k"], "t", "rt", ["t"])


def test_asof_has_no_range_join(spark):
    a = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    b = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("rt"))
    plan = op.asof_join(a, b, ["k"], "t", "rt", ["rt"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
