"""What the physical plans must and must not contain."""

from pyspark.sql import functions as F

from phasediff.plans import lines, phases, positions
from phasediff.sources import files, sinks


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark, fx, tmp_path):
    path = str(tmp_path / "lines")
    fx.budget_line.write.parquet(path)
    plan = plan_of(lines.object_summary(lines.general_fund_lines(spark.read.parquet(path))))
    assert "EqualTo(fund_id,1001)" in plan and "IsNotNull(agency_id)" in plan
    assert "subobject_id" not in plan and "justification" not in plan


def test_one_shuffle_per_side_for_all_changes(spark, fx, tmp_path):
    """Join, uniqueness check, kinds and sentences share one partitioning by job."""
    from phasediff.plans.narrative import full_position_detail, position_sentences

    start, end = str(tmp_path / "s"), str(tmp_path / "e")
    fx.pos_start.write.parquet(start)
    fx.pos_end.write.parquet(end)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = position_sentences(spark.read.parquet(start), spark.read.parquet(end))
        assert plan_of(df).count("Exchange hashpartitioning") == 2
        changes = positions.position_changes(spark.read.parquet(start), spark.read.parquet(end))
        assert plan_of(changes).count("Exchange hashpartitioning") == 2
        detail = full_position_detail(spark.read.parquet(start), spark.read.parquet(end))
        assert plan_of(detail).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_only_the_folders_of_asked_phases_are_read(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 10 AS service_id", "1.5 AS a", "2.5 AS b", "IF(id < 10, 1, NULL) AS c")
    fact = phases.long_fact(df, ["service_id"], {"a": "FY23 CLS", "b": "FY23 TLS", "c": "FY23 BoE"})
    path = sinks.write_versions(fact, str(tmp_path / "fact"))
    stored = files.read_versions(spark, path)
    table = phases.by_phase(stored, ["service_id"], ["FY23 TLS", "FY23 CLS"], F.sum("amount"))
    plan = plan_of(table)
    assert "FY23 TLS" in plan.split("PartitionFilters")[1].split("]")[0] and "partial_" in plan
    assert table.columns == ["service_id", "FY23 TLS", "FY23 CLS"]
    row = phases.phase_change(table, "FY23 CLS", "FY23 TLS").filter("service_id = 3").first()
    assert (row["FY23 TLS"], row["FY23 CLS"], row.change) == (250, 150, 100)
    sinks.write_versions(fact.filter("phase = 'FY23 CLS'").limit(1), path)
    counts = dict(files.read_versions(spark, path).groupBy("phase").count().collect())
    assert counts == {"FY23 CLS": 1, "FY23 TLS": 1000, "FY23 BoE": 1000}
    only = phases.by_phase(stored.filter("amount IS NOT NULL"), ["service_id"], ["FY23 BoE"], F.count(F.lit(1)), base="FY23 BoE")
    assert only.count() == 10


def test_hot_service_meets_the_reducer_pre_aggregated(spark):
    """A third of all lines in one service: each map task sends one row of it."""
    hot = spark.range(3000, numPartitions=6).select(
        F.lit(1).alias("agency_id"),
        F.lit("Parks").alias("agency_name"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("service_id"),
        F.lit("S").alias("service_name"),
        F.lit(3).alias("object_id"),
        F.lit("Contractual Services").alias("object_name"),
        F.lit(1).cast("decimal(18,2)").alias("amount_start"),
        F.lit(2).cast("decimal(18,2)").alias("amount_end"),
    )
    df = lines.object_summary(hot)
    assert "partial_sum" in plan_of(df)
    assert df.filter("service_id = 7").first().amount_start == 1000 + (1 if 7 % 3 else 0)
