import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from phasediff.plans import harvest, lines, service
from phasediff.schema import SHEET_ROW, canonical_name, phase_columns_as_dollars
from phasediff.sources import files, jdbc, sinks


def test_canonical_names():
    assert canonical_name("Program ID") == "service_id"
    assert canonical_name("$ - Change vs Adopted") == "change_vs_adopted"


def test_csv_snapshot_with_headers_that_differ_by_case(spark, tmp_path):
    path = tmp_path / "positions.csv"
    path.write_text("JOB NUMBER,CLASSIFICATION NAME,Classification Name\n7,OLD,Clerk\n")
    schema = "a bigint, b string, c string"
    names = {"a": "job_number", "b": "class_name", "c": "class_name"}
    with pytest.raises(ValueError, match="class_name"):
        files.read_snapshot(spark, str(path), "csv", schema, names, header=True)
    df = files.read_snapshot(spark, str(path), "csv", schema, names, ("class_name",), header=True)
    assert df.columns == ["job_number", "class_name"] and tuple(df.first()) == (7, "OLD")


def test_phase_columns_become_dollars(spark):
    df = spark.range(1).selectExpr("id AS service_id", "1 AS `FY23 Budget`", "2 AS `FY22 Actual`")
    assert phase_columns_as_dollars(df).columns == ["service_id", "FY23 dollars", "FY22 dollars"]


def test_only_the_asked_phase_is_read(spark, tmp_path):
    base = str(tmp_path / "expenditure")
    df = spark.range(10).withColumn("phase", F.when(F.col("id") < 4, "cls").otherwise("prop"))
    df.write.partitionBy("phase").parquet(base)
    cls = files.read_versions(spark, base, ["cls"])
    plan = cls._jdf.queryExecution().executedPlan().toString()
    assert cls.count() == 4 and "(phase#" in plan.split("PartitionFilters")[1]
    assert files.read_versions(spark, base).count() == 10


def test_latest_file_skips_lock_files(spark, tmp_path):
    for i, name in enumerate(("Old Appropriation 1.xlsx", "Appropriation 2.xlsx", "~Appropriation 3.xlsx", "Other.xlsx")):
        path = tmp_path / name
        path.write_text("x")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    row = files.latest_file(spark, str(tmp_path), r"^[^~]*Appropriation.*\.xlsx$").first()
    assert row.path.endswith("Appropriation 2.xlsx") and row.modificationTime.year == 2023


def test_newest_table_is_read_alone(spark, tmp_path):
    folder = str(tmp_path)
    for n, name in enumerate(("FY22 Appropriation.xlsx", "FY23 Appropriation.xlsx", "~FY24 Appropriation.xlsx", "FY24 Other.xlsx")):
        spark.range(3).selectExpr(f"id + {n} AS service_id").coalesce(1).write.parquet(f"{folder}/{name}")
    df = files.read_latest(spark, folder, r"^[^~]*Appropriation.*\.xlsx$", "service_id long")
    assert {f.split("/")[-2].replace("%20", " ") for f in df.inputFiles()} == {"FY23 Appropriation.xlsx"}
    assert sorted(r.service_id for r in df.collect()) == [1, 2, 3]
    with pytest.raises(FileNotFoundError, match="nothing"):
        files.read_latest(spark, folder, "^Budget", "service_id long")


def test_parquet_headers_that_differ_by_case(spark, tmp_path):
    path, own = str(tmp_path / "clash"), files.case_sensitive(spark)
    own.range(4).selectExpr("id AS `JOB NUMBER`", "'OLD' AS `CLASSIFICATION NAME`", "'Clerk' AS `Classification Name`").write.parquet(path)
    with pytest.raises(ValueError, match="class_name"):
        files.read_snapshot(spark, path)
    df = files.read_snapshot(spark, path, duplicates=("class_name",))
    assert df.columns == ["job_number", "class_name"]
    assert df.filter("CLASS_NAME = 'OLD' AND job_number > 1").count() == 2
    assert df.join(spark.range(2).withColumnRenamed("id", "job_number"), "job_number").count() == 2
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_names_are_bound_and_not_put_into_the_statement(spark):
    for phase, n in (("CLS", 3), ("TLS", 5)):
        spark.range(n).createOrReplaceTempView(f"bound_summary_{phase}")
    df = jdbc.phase_tables(spark, "bound_summary", ["CLS", "TLS"], "id > :least", least=1)
    assert sorted((r.phase, r.id) for r in df.collect()) == [("CLS", 2), ("TLS", 2), ("TLS", 3), ("TLS", 4)]
    for hostile in ("bound_summary_CLS; DROP VIEW bound_summary_CLS", "bound_summary_CLS WHERE 1 = 1 --", "(SELECT 1)"):
        with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
            jdbc.bound_table(spark, hostile).collect()
    assert jdbc.bound_table(spark, "bound_summary_CLS", "CAST(id AS STRING) = :x", x="1' OR '1' = '1").count() == 0


def test_rejected_files_and_tabs_are_counted(spark):
    rows = spark.createDataFrame(
        [
            ("/in/FY24 Change Table Parks.xlsx", "012"),
            ("/in/FY24 Change Table Parks.xlsx", "Summary"),
            ("/in/FY24 Change Table Parks.xlsx", None),
            ("/in/~$FY24 Change Table Parks.xlsx", "012"),
            ("/in/book=FY24 Change Table Police.xlsx/part-0.parquet", "7345"),
            ("/in/Other.txt", "012"),
            ("/in/Other.txt", "012"),
        ],
        "file_path string, sheet string",
    )
    found = sorted(map(tuple, files.sheet_rejects(files.classified_sheets(rows)).collect()), key=str)
    assert found == sorted(
        [
            ("FY24 Change Table Parks.xlsx", "Summary", files.OTHER_TAB, 1),
            ("FY24 Change Table Parks.xlsx", None, files.OTHER_TAB, 1),
            ("~$FY24 Change Table Parks.xlsx", "012", files.LOCK_FILE, 1),
            ("Other.txt", "012", files.OTHER_FILE, 2),
        ],
        key=str,
    )
    assert sorted((r.agency, r.service_id) for r in files.sheet_keys(rows).collect()) == [("Parks", "012"), ("Police", "7345")]


def test_many_files_below_a_folder_carry_their_path(spark, tmp_path):
    for folder, name in (("a", "FY24 Change Table Parks.csv"), ("b", "FY24 Change Table Police.csv"), ("b", "Other.csv")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text("012,1,Adjustments,5,,x,,,\n")
    df = files.read_many(spark, str(tmp_path), "FY24 Change Table*", SHEET_ROW)
    keyed = files.sheet_keys(df, extension="csv")
    assert sorted((r.agency, r.service_id) for r in keyed.collect()) == [("Parks", "012"), ("Police", "012")]


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("FINANCE_DB_USER", "reader")
    options = jdbc.jdbc_options("jdbc:x", "s.t", "agency_id", (1, 100), 8)
    assert options["user"] == "reader" and options["numPartitions"] == "8"
    with pytest.raises(ValueError, match="bounds"):
        jdbc.jdbc_options("jdbc:x", "s.t", "agency_id")
    assert jdbc.phase_table("planningyear", "LINE_ITEM_SUMMARY", "TLS") == "planningyear.LINE_ITEM_SUMMARY_TLS"
    with pytest.raises(ValueError, match="table name"):
        jdbc.phase_table("planningyear", "x; drop", None)


def test_export_name():
    name = sinks.export_name("/out/", "Change Table", "FY23 Adopted", "FY24 CLS", dt.date(2024, 1, 2))
    assert name == "/out/ChangeTable_FY23Adopted-FY24CLS_2024-01-02"


def test_folders_are_ordered_and_split(spark, tmp_path):
    """One folder holds nearly all rows, all with one key: they reach several files, in order."""
    df = spark.range(4000, numPartitions=8).selectExpr(
        "IF(id % 100 = 0, 'small & co', 'large') AS agency_name", "5 AS service_id", "id AS v"
    )
    path = str(tmp_path / "out")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        sinks.write_by(sinks.agency_key(df), path, ["agency"], ["service_id"])
    finally:
        spark.conf.set(key, "true")
    assert sorted(os.listdir(path))[-2:] == ["agency=large", "agency=small and co"]
    parts = [f for f in os.listdir(f"{path}/agency=large") if f.endswith(".parquet")]
    assert len(parts) > 1
    assert spark.read.parquet(path).agg(F.sum("v")).first()[0] == sum(range(4000))


def test_rerun_of_one_agency_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(90).selectExpr("concat('a', id % 3) AS agency", "id AS v")
    sinks.write_by(df, path, ["agency"], ["v"])
    sinks.write_by(df.filter("agency = 'a1'").withColumn("v", F.col("v") + 1000), path, ["agency"], ["v"])
    found = {r.agency: (r.n, r.top) for r in spark.read.parquet(path).groupBy("agency").agg(F.count("v").alias("n"), F.max("v").alias("top")).collect()}
    assert found == {"a0": (30, 87), "a1": (30, 1088), "a2": (30, 89)}
    broken = df.filter("agency = 'a2'").withColumn("v", F.expr("IF(v = 89, CAST(raise_error('broken') AS BIGINT), 0)"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_by(broken, path, ["agency"], ["v"])
    assert spark.read.parquet(path).filter("agency = 'a2'").count() == 30
    sinks.write_by(df.filter("agency = 'a0'"), path, ["agency"], ["v"], whole=True)
    assert spark.read.parquet(path).count() == 30


def test_service_tables_are_written_for_chosen_agencies(spark, fx, tmp_path):
    items = service.phase_line_items(fx.expend_cls, fx.expend_prop)
    summary = service.service_summary(items, service.phase_position_counts(**fx.pos_phases))
    drivers = service.cost_drivers(fx.expend_cls, fx.expend_prop)
    written = sinks.export_service_tables(summary, drivers, fx.assignment, str(tmp_path / "out"))
    chosen = service.operational_agencies(fx.assignment)
    for name in ("budget_table", "dollars_by_service", "positions_by_service", "dollars_by_fund"):
        table = spark.read.parquet(written[name])
        assert table.count() > 0
        assert table.join(chosen, "agency_name", "left_anti").count() == 0
    expected = service.agency_dollars_by_fund(summary).join(chosen, "agency_name", "left_semi")
    assert spark.read.parquet(written["dollars_by_fund"]).count() == expected.count()


def test_change_sheets_by_service_folders(spark, fx, tmp_path):
    gf = lines.general_fund_lines(fx.budget_line)
    note = spark.createDataFrame(
        [],
        "service_id bigint, object_id int, note_no bigint, position_note string, total_cost_diff decimal(38,2)",
    )
    sheet = lines.full_change_sheet(lines.service_object_totals(gf), note)
    path = sinks.export_change_sheets(sheet, fx.assignment, str(tmp_path / "out"), by_service=True)
    table = spark.read.parquet(path)
    agencies = service.operational_agencies(fx.assignment, require_analyst=False)
    active = lines.active_services(sheet).join(agencies, "agency_name", "left_semi")
    assert table.select("agency_name", "service_id").distinct().count() == active.count()
    folder = next(d for d in os.listdir(path) if d.startswith("agency="))
    assert any(d.startswith("service_id=") for d in os.listdir(f"{path}/{folder}"))


def test_pillar_and_measure_folders(spark, fx, tmp_path):
    pillars = harvest.pillar_map(fx.expend_prop)
    book = harvest.pillar_book(harvest.ladder_with_pillar(harvest.ladder_rows(fx.sheet_row), pillars))
    path = sinks.export_pillar_book(book, str(tmp_path / "book"))
    found = {d.split("=")[1] for d in os.listdir(path) if d.startswith("pillar=")}
    assert {f.replace("%20", " ") for f in found} == {r.pillar for r in harvest.pillar_list(book).collect()}
    measures = harvest.measures_by_pillar(fx.measure, pillars)
    path = sinks.export_measures(measures, str(tmp_path / "measures"))
    assert spark.read.parquet(path).count() == measures.count()


def test_phases_are_stored_without_a_sort(spark, tmp_path):
    """Rows of all phases alternate; a sort by folder would take every row of a long fact through memory or disk."""
    fact = spark.range(1000).selectExpr("id", "concat('p', id % 5) AS phase")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    path = sinks.write_versions(fact, str(tmp_path / "versions"))
    plan = spark._jsparkSession.sharedState().statusStore().executionsList().last().physicalPlanDescription()
    assert "InsertIntoHadoopFsRelationCommand" in plan and "Sort" not in plan
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, fact.collect()))


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    path = str(tmp_path / "folders")
    rows = spark.range(150).selectExpr("id", "id AS folder").coalesce(1)
    rows.write.partitionBy("folder").parquet(path)
    tracker, group = spark.sparkContext.statusTracker(), "listing of folders"
    spark.sparkContext.setJobGroup(group, group)
    try:
        table = files.read_folders(spark, path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert 1 < max(tracker.getStageInfo(s).numTasks for s in stages) <= files.LISTING_TASKS * spark.sparkContext.defaultParallelism
    assert sorted(map(tuple, table.collect())) == [(k, k) for k in range(150)]
