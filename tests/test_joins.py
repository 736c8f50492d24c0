import pytest
from pyspark.sql import functions as F

from phasediff.operators.joins import lookup_join, null_safe_join
from phasediff.operators.ordering import presentation_sort
from phasediff.operators.scratch import materialize, scratch_dir


def skewed(spark):
    """A third of all rows share one key and are exact copies; some keys have no match."""
    return spark.range(9000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"),
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_plain_join(spark, how):
    fact = skewed(spark)
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("name"))
    salted = lookup_join(fact, dim, ["k"], how, limit_bytes=0)
    assert "BroadcastExchange" not in _plan_without_auto(spark, salted)
    assert sorted(map(str, salted.collect())) == sorted(
        map(str, fact.join(dim, ["k"], how).collect())
    )


def _plan_without_auto(spark, df):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = df.select("*")
        return again._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_salting_splits_the_hot_key(spark):
    fact = skewed(spark)
    salted = fact.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(16)))
    per_salt = salted.filter("k = 7").groupBy("_salt").count().collect()
    assert len(per_salt) == 12
    assert max(r["count"] for r in per_salt) < 400


def test_small_dimension_is_broadcast_and_large_one_is_not(spark):
    fact = skewed(spark)
    small = spark.range(40).select(F.col("id").alias("k"))
    plan = lookup_join(fact, small, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_salt" not in plan
    large = spark.range(10_000_000).select(F.col("id").alias("k"))
    assert "_salt" in _plan_without_auto(spark, lookup_join(fact, large, ["k"]))


def test_lookup_join_keeps_the_fact_side(spark):
    with pytest.raises(ValueError, match="fact side"):
        lookup_join(skewed(spark), skewed(spark), ["k"], "full_outer")


def test_null_keys_match_each_other(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    rows = {(r.k, r.x, r.y) for r in null_safe_join(left, right, ["k"]).collect()}
    assert rows == {(None, 1, 10), ("a", 2, 20), ("b", 3, None)}


def test_presentation_sort_puts_nulls_last_and_keeps_all_rows(spark):
    df = spark.createDataFrame([(2,), (None,), (1,), (2,)], "a int")
    assert [r.a for r in presentation_sort(df, "a").collect()] == [1, 2, 2, None]
    assert presentation_sort(df, F.desc_nulls_last("a")).columns == ["a"]


def test_materialize_uses_the_shared_folder(spark):
    df = spark.range(5).withColumn("amount", F.lit("1.50").cast("decimal(28,2)"))
    table = materialize(df, "test")
    assert table.schema.simpleString() == df.schema.simpleString()
    assert sorted(table.collect()) == sorted(df.collect())
    folder = spark.conf.get("spark.checkpoint.dir", None)
    shared = folder or spark.conf.get("spark.sql.warehouse.dir")
    assert scratch_dir(spark).startswith(shared)
    assert all("/scratch/" in f or (folder and folder in f) for f in table.inputFiles())
