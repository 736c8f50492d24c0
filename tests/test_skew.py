"""Joins with a hot key on both sides, and ordinals in a hot group."""

import pytest
from pyspark.sql import functions as F

from phasediff.operators.ordinals import numbered_within
from phasediff.operators.skew import heavy_keys, skew_join


@pytest.fixture
def small_limit(spark, monkeypatch):
    monkeypatch.setattr("phasediff.operators.joins.BROADCAST_LIMIT_BYTES", 0)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("-1", "false", "48")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def side(spark, n, value, missing=0):
    """A third of the rows has key 7; every ninth row is an exact copy, every eleventh has no key."""
    return spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 != 1, F.col("id") % 90 + missing).alias("k"),
        F.when(F.col("id") % 9 == 0, F.lit(0)).otherwise(F.col("id")).alias(value),
    )


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_on_both_sides(spark, small_limit, how):
    left, right = side(spark, 3000, "x"), side(spark, 900, "y", missing=45)
    joined = skew_join(left, right, ["k"], how)
    assert joined.columns == ["k", "x", "y"]
    assert rows(joined) == rows(left.join(right, ["k"], how))
    per_task = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    plain = [r["count"] for r in left.join(right, ["k"], how).groupBy(F.spark_partition_id()).count().collect()]
    assert max(plain) > 0.9 * sum(plain)
    assert max(per_task) < 0.12 * sum(per_task)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_key_on_one_side_only(spark, small_limit, how):
    hot, even = side(spark, 2000, "x"), spark.range(300).selectExpr("id % 100 AS k", "id AS y")
    for left, right in ((hot, even), (even.withColumnRenamed("y", "x"), hot.withColumnRenamed("x", "y"))):
        assert rows(skew_join(left, right, ["k"], how)) == rows(left.join(right, ["k"], how))
        none = right.filter("k <> 7")
        assert rows(skew_join(left, none, ["k"], how)) == rows(left.join(none, ["k"], how))
        assert rows(skew_join(left, right.limit(0), ["k"], how)) == rows(left.join(right.limit(0), ["k"], how))


def test_keys_of_several_columns(spark, small_limit):
    left, right = side(spark, 1500, "x").withColumn("q", F.lit("a")), side(spark, 600, "y").withColumn("q", F.lit("a"))
    assert rows(skew_join(left, right, ["k", "q"])) == rows(left.join(right, ["k", "q"], "left"))


def test_even_keys_are_neither_salted_nor_copied(spark, small_limit):
    left, right = spark.range(5000).selectExpr("id AS k", "1 AS x"), spark.range(4000).selectExpr("id AS k", "2 AS y")
    plan = skew_join(left, right, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "_copies" not in plan and "Generate" not in plan


def test_small_right_side_is_broadcast(spark):
    left, right = side(spark, 300, "x"), spark.range(20).selectExpr("id AS k", "id AS y")
    assert "BroadcastHashJoin" in skew_join(left, right, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_heavy_keys_are_measured(spark):
    n, found = heavy_keys(side(spark, 9000, "x"), ["k"])
    key = spark.sql("SELECT xxhash64(7L) AS h").first().h
    assert n == 9000 and abs(found[key] - 3000) < 200


@pytest.mark.parametrize("partitions", ["1", "48"])
def test_ordinals_of_a_hot_group(spark, small_limit, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 5 WHEN id % 30 = 0 THEN NULL ELSE id END AS g", "pmod(id * 7919, 3001) AS o", "'x' AS rest"
    )
    found = numbered_within(df, ["g"], ["o"], "n")
    assert found.columns == ["g", "o", "rest", "n"]
    groups = {}
    for r in df.collect():
        groups.setdefault(r.g, []).append(r.o)
    expected = sorted((g if g is not None else -1, o, k) for g, os in groups.items() for k, o in enumerate(sorted(os), 1))
    assert sorted((r.g if r.g is not None else -1, r.o, r.n) for r in found.collect()) == expected
