"""One registered query per operator: fixtures in, a DataFrame out."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phasediff import constants as K
from phasediff.functions.columns import position_in, sum0
from phasediff.operators.joins import null_safe_join
from phasediff.operators.scratch import materialize, scratch_path
from phasediff.plans import (
    finance,
    harvest,
    ladder,
    lines,
    narrative,
    notes,
    phases,
    positions,
    service,
)
from phasediff.sources import files, jdbc, sinks
from phasediff.verify.fixtures import Fixtures

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Callable[[Fixtures], DataFrame]] = {}


def query(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


def plain(df: DataFrame) -> DataFrame:
    """Exact decimals become doubles in the outermost select, as on the SQL side."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in decimals}) if decimals else df


def registered() -> dict[str, Query]:
    def runner(build):
        return lambda spark, folder: plain(build(Fixtures(spark, folder)))

    return {name: runner(build) for name, build in REGISTRY.items()}


# ---------------------------------------------------------------- line items


def _gf(fx: Fixtures) -> DataFrame:
    return lines.general_fund_lines(fx.general_line)


def _totals(fx: Fixtures) -> DataFrame:
    return materialize(lines.service_object_totals(_gf(fx)), "service_object_totals")


def _sentences(fx: Fixtures) -> DataFrame:
    return narrative.position_sentences(fx.pos_start, fx.pos_end)


def _note(fx: Fixtures) -> DataFrame:
    return narrative.position_note(narrative.position_summary(_sentences(fx)))


def _dense(totals: DataFrame, note: DataFrame) -> DataFrame:
    summary = lines.object_summary(totals)
    rows, told = lines.object_rows(summary, note), lines.note_lines(summary, note)
    return lines.change_rows_dense(lines.object_service_grid(totals), rows, told)


def _sheet(fx: Fixtures) -> DataFrame:
    return lines.full_change_sheet(_totals(fx), _note(fx))


@query
def service_allow_list(fx):
    return lines.service_allow_list(fx.budget_line)


@query
def general_fund_lines(fx):
    return _gf(fx)


@query
def object_detail(fx):
    return lines.object_detail(_gf(fx))


@query
def object_summary(fx):
    return lines.object_summary(_gf(fx))


@query
def significant_change(fx):
    return lines.significant_changes(lines.object_detail(_gf(fx)))


@query
def budget_bookends(fx):
    return lines.budget_bookends(_gf(fx))


@query
def object_service_grid(fx):
    return lines.object_service_grid(_gf(fx))


@query
def change_rows(fx):
    return lines.change_rows(lines.object_summary(_totals(fx)), _note(fx))


@query
def change_rows_dense(fx):
    return _dense(_totals(fx), _note(fx))


@query
def change_sheet(fx):
    totals = _totals(fx)
    return lines.change_sheet(lines.budget_bookends(totals), _dense(totals, _note(fx)))


@query
def change_sheet_with_adjustments(fx):
    """The sheet by agency with two sources of notes on one row."""
    flat = notes.flat_adjustments(fx.flat_adjustment)
    return lines.full_change_sheet(_totals(fx), _note(fx), adjustments=flat)


@query
def change_sheet_by_agency(fx):
    return _sheet(fx)


@query
def active_services(fx):
    return lines.active_services(_sheet(fx))


@query
def services_with_amounts(fx):
    return lines.services_with_amounts(lines.service_object_totals(_gf(fx)))


# ---------------------------------------------------------------- positions


def _pairs(fx: Fixtures) -> DataFrame:
    return positions.position_pairs(fx.pos_start, fx.pos_end)


def _moves(fx: Fixtures) -> DataFrame:
    return positions.positions_fund_moves(_pairs(fx))


@query
def position_clean(fx):
    return positions.position_clean(fx.pos_with_cost_codes)


@query
def positions_created(fx):
    return positions.positions_created(fx.pos_start, fx.pos_end)


@query
def positions_eliminated(fx):
    return positions.positions_eliminated(fx.pos_start, fx.pos_end)


@query
def positions_service_in(fx):
    return positions.positions_service_in(_pairs(fx))


@query
def positions_service_out(fx):
    return positions.positions_service_out(_pairs(fx))


@query
def positions_reclassified(fx):
    return positions.positions_reclassified(_pairs(fx))


@query
def positions_fund_moves(fx):
    return _moves(fx)


@query
def positions_fund_out(fx):
    return positions.positions_fund_out(_moves(fx))


@query
def positions_fund_in(fx):
    return positions.positions_fund_in(_moves(fx))


@query
def positions_fund_non_gf(fx):
    return positions.positions_fund_non_gf(_moves(fx))


@query
def position_changes(fx):
    return positions.position_changes(fx.pos_start, fx.pos_end)


@query
def position_sentences(fx):
    return _sentences(fx)


@query
def position_detail(fx):
    return narrative.full_position_detail(fx.pos_start, fx.pos_end)


@query
def position_summary(fx):
    return narrative.position_summary(_sentences(fx))


@query
def position_note(fx):
    return _note(fx)


# ---------------------------------------------------------------- services and agencies


def _counts(fx: Fixtures) -> DataFrame:
    return service.phase_position_counts(**fx.pos_phases)


def _lines(fx: Fixtures) -> DataFrame:
    return service.phase_line_items(fx.expend_cls, fx.expend_prop)


def _summary(fx: Fixtures) -> DataFrame:
    return service.service_summary(_lines(fx), _counts(fx))


def _drivers(fx: Fixtures) -> DataFrame:
    return service.cost_drivers(fx.expend_cls, fx.expend_prop)


@query
def operational_agencies(fx):
    return service.operational_agencies(fx.assignment)


@query
def sheet_agencies(fx):
    return service.operational_agencies(fx.assignment, require_analyst=False)


@query
def phase_line_items(fx):
    return _lines(fx)


@query
def phase_position_counts(fx):
    return _counts(fx)


@query
def service_summary(fx):
    return _summary(fx)


@query
def service_row_counts(fx):
    return service.service_row_counts(_summary(fx))


@query
def cost_drivers(fx):
    return _drivers(fx)


@query
def service_budget_table(fx):
    return service.service_budget_table(_summary(fx))


@query
def general_fund_ladder(fx):
    return ladder.general_fund_ladder(_summary(fx), _drivers(fx))


@query
def agency_dollars_by_service(fx):
    return service.agency_dollars_by_service(_summary(fx))


@query
def agency_positions_by_service(fx):
    return service.agency_positions_by_service(_summary(fx))


@query
def agency_dollars_by_fund(fx):
    return service.agency_dollars_by_fund(_summary(fx))


@query
def service_cost_drivers(fx):
    return service.service_cost_drivers(_drivers(fx))


# ---------------------------------------------------------------- completed sheets


def _ladder_rows(fx: Fixtures) -> DataFrame:
    return harvest.ladder_with_pillar(
        harvest.ladder_rows(fx.sheet_row), harvest.pillar_map(fx.expend_prop)
    )


@query
def sheet_keys(fx):
    return harvest.sheet_keys(fx.whole_sheet_row)


@query
def technical_block(fx):
    return harvest.technical_block(fx.sheet_row)


@query
def savings_block(fx):
    return harvest.savings_block(fx.sheet_row)


@query
def technical_adjustments(fx):
    return harvest.technical_adjustments(harvest.technical_block(fx.sheet_row))


@query
def savings_ideas(fx):
    return harvest.savings_ideas(harvest.savings_block(fx.sheet_row))


@query
def service_coverage(fx):
    return harvest.service_coverage(harvest.savings_ideas(harvest.savings_block(fx.sheet_row)))


@query
def ladder_rows(fx):
    return harvest.ladder_rows(fx.sheet_row)


@query
def pillar_map(fx):
    return harvest.pillar_map(fx.expend_prop)


@query
def ladder_with_pillar(fx):
    return _ladder_rows(fx)


@query
def pillar_list(fx):
    return harvest.pillar_list(_ladder_rows(fx))


@query
def pillar_book(fx):
    return harvest.pillar_book(_ladder_rows(fx))


@query
def measures_by_pillar(fx):
    return harvest.measures_by_pillar(fx.measure, harvest.pillar_map(fx.expend_prop))


# ---------------------------------------------------------------- finance extracts


@query
def line_detail(fx):
    return finance.line_detail(fx.line_item_detail)


@query
def line_summary(fx):
    return finance.line_summary(fx.line_item_summary)


@query
def line_summary_from_lines(fx):
    return finance.line_summary(fx.line_item_summary_long)


@query
def opc_report(fx):
    return finance.opc_report(fx.all_opcs)


@query
def expenditure_detail(fx):
    return finance.expenditure_detail(fx.cur_expend_table, fx.line_item_report, fx.carry_fwd)


@query
def expenditure_by_agency_fund(fx):
    return finance.expenditure_by_agency_fund(fx.line_item_detail)


@query
def expenditure_summary(fx):
    return finance.expenditure_summary(fx.cur_expend)


@query
def multi_phase_gf(fx):
    return finance.multi_phase_gf(fx.line_item_detail, finance.LINE_PHASES)


# ---------------------------------------------------------------- notes


@query
def analyst_notes(fx):
    return notes.analyst_notes(fx.note_row)


@query
def notes_gaps(fx):
    sheets = notes.analyst_notes(fx.note_row)
    stacked = sheets.filter(F.col("analyst_notes").isNotNull())
    return notes.notes_gaps(stacked, sheets, _gf(fx).filter(F.col("amount_start") > 0))


@query
def carry_forward_notes(fx):
    return notes.carry_forward_notes(_sheet(fx), notes.analyst_notes(fx.note_row))


@query
def flat_adjustments(fx):
    return notes.flat_adjustments(fx.flat_adjustment)


# ---------------------------------------------------------------- outputs, read back


@query
def export_change_sheets(fx):
    path = scratch_path(fx.spark, "change_sheets")
    sinks.export_change_sheets(_sheet(fx), fx.assignment, path)
    return fx.spark.read.parquet(path)


@query
def export_service_ladders(fx):
    path = scratch_path(fx.spark, "service_tables")
    summary = materialize(_summary(fx), "service_summary")
    written = sinks.export_service_tables(summary, _drivers(fx), fx.assignment, path)
    return fx.spark.read.parquet(written["ladder"])


@query
def export_pillar_book(fx):
    path = scratch_path(fx.spark, "pillar_book")
    sinks.export_pillar_book(harvest.pillar_book(_ladder_rows(fx)), path)
    return fx.spark.read.parquet(path)


@query
def export_measures(fx):
    path = scratch_path(fx.spark, "measures")
    sinks.export_measures(
        harvest.measures_by_pillar(fx.measure, harvest.pillar_map(fx.expend_prop)), path
    )
    return fx.spark.read.parquet(path)


@query
def export_technical_adjustments(fx):
    path = scratch_path(fx.spark, "technical_adjustments")
    entries = harvest.technical_adjustments(harvest.technical_block(fx.sheet_row))
    return fx.spark.read.schema(entries.schema).parquet(sinks.write_table(entries, path))


@query
def export_change_sheets_by_service(fx):
    """A folder per agency and service; one agency is then written again and the others stay."""
    path = scratch_path(fx.spark, "change_sheets_by_service")
    sheet = materialize(_sheet(fx), "change_sheet")
    sinks.export_change_sheets(sheet, fx.assignment, path, by_service=True)
    again = sheet.filter(F.col("agency_name") == sheet.agg(F.min("agency_name")).scalar())
    sinks.export_change_sheets(again, fx.assignment, path, by_service=True)
    return files.read_folders(fx.spark, path)


@query
def export_full_change_sheet(fx):
    sheet = _sheet(fx)
    name = sinks.export_name("full", "OSO Changes", "FY23 Adopted", "FY24 CLS", dt.date(2024, 1, 2))
    path = sinks.write_table(sheet, scratch_path(fx.spark, name.replace("/", "-")))
    return fx.spark.read.schema(sheet.schema).parquet(path)


def _service_report(fx: Fixtures, name: str) -> DataFrame:
    path = scratch_path(fx.spark, name)
    summary = materialize(_summary(fx), "service_summary")
    written = sinks.export_service_tables(summary, _drivers(fx), fx.assignment, path, only=(name,))
    return fx.spark.read.parquet(written[name])


@query
def export_budget_tables(fx):
    return _service_report(fx, "budget_table")


@query
def export_dollars_by_service(fx):
    return _service_report(fx, "dollars_by_service")


@query
def export_positions_by_service(fx):
    return _service_report(fx, "positions_by_service")


@query
def export_dollars_by_fund(fx):
    return _service_report(fx, "dollars_by_fund")


@query
def export_savings_ideas(fx):
    path = scratch_path(fx.spark, "savings_ideas")
    entries = harvest.savings_ideas(harvest.savings_block(fx.sheet_row))
    return fx.spark.read.schema(entries.schema).parquet(sinks.write_table(entries, path))


# ---------------------------------------------------------------- sources, written and read back


@query
def service_allow_list_from_files(fx):
    """The newest appropriation file of several; the newest of all is a lock file."""
    folder = scratch_path(fx.spark, "appropriations")
    lines_ = fx.budget_line.select("agency_name", "service_id").distinct()
    files_ = {
        "FY23 Appropriation.xlsx": lines_.filter("service_id % 2 = 0"),
        "FY24 Appropriation.xlsx": lines_,
        "FY24 Other.xlsx": lines_.limit(1),
        "~FY25 Appropriation.xlsx": lines_.limit(1),
    }
    for name, df in files_.items():
        df.write.parquet(f"{folder}/{name}")
    newest = files.read_latest(fx.spark, folder, r"^[^~]*Appropriation.*\.xlsx$", lines_.schema)
    return lines.service_allow_list(newest)


def _stored_fact(fx: Fixtures) -> DataFrame:
    keys = ["agency_name", "program_id", "fund_name"]
    fact = phases.long_fact(fx.line_item_detail, keys, finance.LINE_PHASES)
    path = sinks.write_versions(fact, scratch_path(fx.spark, "line_versions"))
    return files.read_versions(fx.spark, path).withColumnRenamed("program_id", "service_id")


@query
def phase_amounts(fx):
    """Two of the five phases of a stored fact, in any order; only their folders are read."""
    keys, chosen = ["agency_name", "service_id", "fund_name"], ["FY23 TLS", "FY22 Adopted"]
    table = phases.by_phase(_stored_fact(fx), keys, chosen, F.sum("amount"))
    return phases.phase_change(table, "FY22 Adopted", "FY23 TLS")


@query
def phase_job_counts(fx):
    keys = ["agency_name", "service_id", "fund_name"]
    fact = phases.stacked_snapshots(fx.pos_phases, keys)
    stored = files.read_versions(fx.spark, sinks.write_versions(fact, scratch_path(fx.spark, "job_versions")))
    return phases.by_phase(stored, keys, ["prior", "planning"], F.count(F.lit(1)), base="planning")


@query
def phase_sequence_amounts(fx):
    """All phases from one to another of a fiscal year."""
    chosen = notes.phase_sequence((23, "CLS"), (23, "TLS"))
    return phases.by_phase(_stored_fact(fx), ["fund_name"], chosen, F.sum("amount"))


@query
def line_summary_by_phase(fx):
    """Two phase tables by name and one bound value, then the extract for each."""
    stem = f"line_item_summary_{uuid.uuid4().hex}"
    table = materialize(fx.line_item_summary, "line_item_summary")
    doubled = table.withColumns({f"fund_{i}": F.col(f"fund_{i}") * 2 for i in K.SUMMARY_FUNDS})
    table.createOrReplaceTempView(f"{stem}_CLS")
    doubled.createOrReplaceTempView(f"{stem}_TLS")
    both = jdbc.phase_tables(fx.spark, stem, ["CLS", "TLS"], "agency_id <= :most", most=20)
    parts = [finance.line_summary(both.filter(F.col("phase") == p)).withColumn("phase", F.lit(p)) for p in ("CLS", "TLS")]
    return parts[0].unionByName(parts[1])


@query
def expenditure_by_bound_table(fx):
    name = f"line_item_report_{uuid.uuid4().hex}"
    fx.line_item_detail.createOrReplaceTempView(name)
    return finance.expenditure_by_agency_fund(jdbc.bound_table(fx.spark, name))


def _stored_sheets(fx: Fixtures) -> DataFrame:
    """The sheets as files, among them lock files and files of other kinds, read in one scan."""
    path = scratch_path(fx.spark, "sheets")
    name = F.element_at(F.split("file_path", "/"), -1)
    service_no = F.regexp_extract("sheet", r"(\d{3,})", 1).try_cast("bigint") % 10
    extra = F.when(service_no == 3, F.concat(F.lit("~$"), name)).when(
        service_no == 4, F.replace(name, F.lit("FY24 Change Table"), F.lit("Notes"))
    )
    books = fx.sheet_row.withColumn("book", F.explode(F.array_compact(F.array(name, extra)))).drop("file_path")
    books.write.partitionBy("book").parquet(path)
    schema = fx.sheet_row.drop("file_path").schema
    return files.classified_sheets(files.read_many(fx.spark, path, "*", schema, "parquet"))


@query
def sheet_keys_from_files(fx):
    kept = _stored_sheets(fx).filter(F.col("reject").isNull())
    return kept.groupBy("agency", "service_id").agg(F.count(F.lit(1)).alias("sheet_rows"))


@query
def sheet_rejects(fx):
    return files.sheet_rejects(_stored_sheets(fx))


@query
def snapshot_with_clashing_headers(fx):
    """A stored snapshot in which two headers differ only by case; the first of them counts."""
    own = files.case_sensitive(fx.spark)
    given = fx.pos_all_end.selectExpr("job_number", "agency_id", "upper(class_name) AS u", "class_name", "total_cost")
    path = scratch_path(fx.spark, "clashing")
    plain_table = materialize(given, "positions")
    headers = ("JOB NUMBER", "AGENCY ID", "CLASSIFICATION NAME", "Classification Name", "Total Cost")
    own.read.schema(plain_table.schema).parquet(plain_table.inputFiles()[0].rpartition("/")[0]).toDF(*headers).write.parquet(path)
    return files.read_snapshot(fx.spark, path, duplicates=("class_name",))


# ---------------------------------------------------------------- primitives


@query
def prim_anti_join(fx):
    start = fx.pos_start.select("job_number")
    end = fx.pos_end.select("job_number", "service_id")
    return end.join(start, end.job_number.eqNullSafe(start.job_number), "left_anti")


@query
def prim_full_outer(fx):
    def per_service(df, name):
        return df.groupBy("service_id").agg(F.count(F.lit(1)).alias(name))

    cls = per_service(fx.expend_cls, "cls_lines")
    return cls.join(per_service(fx.expend_prop, "request_lines"), "service_id", "full_outer")


@query
def prim_unpivot(fx):
    return fx.budget_line.select("service_id", "object_id", "amount_start", "amount_end").unpivot(
        ["service_id", "object_id"], ["amount_start", "amount_end"], "phase", "amount"
    )


@query
def prim_rollup(fx):
    rolled = fx.budget_line.rollup("agency_name").agg(
        sum0("amount_end").alias("amount_end"), F.grouping("agency_name").alias("_total")
    )
    label = F.when(F.col("_total") == 1, F.lit("Total")).otherwise(F.col("agency_name"))
    return rolled.select(label.alias("agency_name"), "amount_end")


@query
def prim_ordered_listagg(fx):
    """Names of the objects of a service, in order: at most one entry per object."""
    pairs = fx.budget_line.select("service_id", "object_name").distinct()
    return pairs.groupBy("service_id").agg(
        F.expr("listagg(object_name, '; ') WITHIN GROUP (ORDER BY object_name)").alias("objects")
    )


@query
def prim_first_per_key(fx):
    """The best-paid job of each service: the row number is cut off before the shuffle."""
    best = Window.partitionBy("service_id").orderBy(F.desc_nulls_last("salary"), "job_number")
    return (
        fx.pos_all_end.select("service_id", "job_number", "class_name", "salary")
        .withColumn("_n", F.row_number().over(best))
        .filter("_n = 1")
        .drop("_n")
    )


@query
def prim_bool_or(fx):
    return fx.budget_line.groupBy("service_id").agg(
        F.coalesce(F.bool_or(F.col("amount_end") != 0), F.lit(False)).alias("has_budget")
    )


@query
def prim_conditional_sum(fx):
    return fx.budget_line.groupBy("agency_name").agg(
        F.expr("sum(amount_end) FILTER (WHERE fund_id = 1001)").alias("general"),
        F.expr("sum(amount_end) FILTER (WHERE fund_id <> 1001)").alias("other"),
    )


@query
def prim_null_safe_join(fx):
    """Jobs per agency in both snapshots, the rows without an agency matched to each other."""

    def per_agency(df, name):
        return df.groupBy("agency_name").agg(F.count(F.lit(1)).alias(name))

    start, end = per_agency(fx.pos_all_start, "start_jobs"), per_agency(fx.pos_all_end, "end_jobs")
    return null_safe_join(start, end, ["agency_name"])


@query
def prim_ordinal_sort(fx):
    funds = fx.budget_line.groupBy("fund_name").agg(F.count(F.lit(1)).alias("lines"))
    order = position_in("fund_name", K.FUND_ORDER)
    return funds.withColumn("fund_order", order).orderBy("fund_order", "fund_name")


@query
def prim_regexp_extract(fx):
    return fx.sheet_row.select(
        "file_path",
        "sheet",
        "row_no",
        F.regexp_extract("file_path", r"Table (.+)\.xlsx$", 1).alias("agency"),
        F.regexp_extract("sheet", r"(\d{3,})", 1).alias("service_id"),
    )
