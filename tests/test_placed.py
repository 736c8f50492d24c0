"""Left joins in the order of a report that move the wide rows once."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from phasediff.operators import placed
from phasediff.operators.placed import ordered_left_joins
from phasediff.verify.compare import differences, oracle_connection
from phasediff.verify.oracle import oracles
from phasediff.verify.queries import registered
from tests.conftest import DATA
from tests.test_oracle import FORBIDDEN


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr("phasediff.operators.joins.BROADCAST_LIMIT_BYTES", 0)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.debug.maxToStringFields")
    before = {n: spark.conf.get(n) for n in names}
    for name, value in zip(names, ("-1", "true", "200")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def lines(spark, n=4000):
    """A third of the lines has key 7 and one name; some lack the first key, the second key, the name or the amount."""
    return spark.range(n, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 != 1, F.col("id") % 300).alias("k"),
        F.when(F.col("id") % 5 != 2, F.col("id") % 4).alias("q"),
        F.when(F.col("id") % 3 == 0, "same").when(F.col("id") % 13 != 4, F.concat(F.lit("n"), F.col("id") * 7919 % 997)).alias("name"),
        F.when(F.col("id") % 17 != 3, F.expr("CAST(id * IF(id % 19 = 5, 100000000000000000000, 1) AS DECIMAL(30,2)) - 50")).alias("amount"),
    )


def reasons(spark):
    """Two for every fourth key, one of them without a text; none for half of the keys; copies of a row."""
    twice = spark.range(300).filter("id % 4 = 0").selectExpr("id AS k", "explode(array('a', NULL, 'a')) AS why")
    return twice.unionByName(spark.range(1, 300, 4).selectExpr("id AS k", "concat('b', id) AS why"))


def purposes(spark):
    return spark.range(0, 1300, 3).selectExpr("id % 310 AS k", "IF(id % 7 = 0, NULL, id % 4) AS q", "concat('p', id) AS text")


def rows(df):
    return sorted(map(str, df.collect()))


def plain(left, why, text):
    return left.join(why, ["k"], "left").join(text, ["k", "q"], "left").select("k", "q", "name", "amount", "why", "text")


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("cells", [2, 20])
def test_rows_and_order(spark, no_broadcast, monkeypatch, cells, adaptive):
    """The key 7 of the left side is no hot key with 2 cells and is one with 20."""
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    monkeypatch.setattr(placed, "PLACE_ROWS", 150)
    left, why, text = lines(spark), reasons(spark), purposes(spark)
    done = ordered_left_joins(left, [(why, ["k"]), (text, ["k", "q"])], ["name", "amount"], cells=cells)
    assert rows(done) == rows(plain(left, why, text))
    assert done.schema["amount"].dataType == left.schema["amount"].dataType
    keys = [(r.name is None, r.name or "", r.amount is None, r.amount or Decimal(0)) for r in done.collect()]
    assert keys == sorted(keys)


def test_small_right_side_beside_a_large_one(spark, no_broadcast, monkeypatch):
    sizes = iter([1, 0])
    monkeypatch.setattr(placed, "estimated_bytes", lambda df: next(sizes))
    left, why, text = lines(spark), reasons(spark), purposes(spark)
    done = ordered_left_joins(left, [(why, ["k"]), (text, ["k", "q"])], ["name"], cells=2)
    assert rows(done) == rows(plain(left, why, text))


def test_right_side_with_a_hot_key(spark, no_broadcast):
    left, text = lines(spark, 900), purposes(spark)
    why = reasons(spark).unionByName(spark.range(500).selectExpr("7L AS k", "concat('h', id) AS why"))
    done = ordered_left_joins(left, [(why, ["k"]), (text, ["k", "q"])], ["name"])
    assert rows(done) == rows(plain(left, why, text))


def test_ties_are_spread(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(placed, "PLACE_ROWS", 200)
    left = lines(spark, 6000).filter("k = 7").repartition(24)
    done = ordered_left_joins(left, [(reasons(spark), ["k"])], ["name"], cells=2)
    per_task = [r["count"] for r in done.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == left.count() and max(per_task) < 0.4 * sum(per_task)


def test_no_lines(spark, no_broadcast):
    done = ordered_left_joins(lines(spark, 0), [(reasons(spark), ["k"]), (purposes(spark), ["k", "q"])], ["name"], cells=2)
    assert done.collect() == []


def test_expenditure_detail_moves_wide_rows_once(spark, no_broadcast):
    df = registered()["expenditure_detail"](spark, DATA)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    moved = re.findall(r"\(\d+\) Exchange\n(?:Input|Output) \[\d+\]: \[(.*)\]", plan)
    assert len(moved) > 1 and sum("jul#" in columns for columns in moved) == 1
    assert not [node for node in FORBIDDEN if node in plan]
    assert differences(df, oracle_connection(DATA), oracles()["expenditure_detail"]) == []
