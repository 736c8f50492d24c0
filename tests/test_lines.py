from decimal import Decimal as D

from pyspark.sql import functions as F

from phasediff.plans import lines as L
from phasediff.schema import BUDGET_LINE

KEYS = (
    "agency_id agency_name service_id service_name activity_id activity_name fund_id fund_name "
    "object_id object_name subobject_id subobject_name objective_name amount_start amount_end "
    "justification"
).split()


def line(service=5, obj=(3, "Contractual Services"), start=None, end=None, **other):
    base = dict.fromkeys(KEYS) | {
        "agency_id": 1, "agency_name": "Parks", "service_id": service, "service_name": f"S{service}",
        "fund_id": 1001, "fund_name": "General", "object_id": obj[0], "object_name": obj[1],
        "amount_start": None if start is None else D(start),
        "amount_end": None if end is None else D(end),
    }
    return tuple((base | other)[k] for k in KEYS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), BUDGET_LINE)


PAY, BENEFITS = (1, "Salaries"), (2, "Other Personnel Costs")
NO_NOTE = (
    "service_id bigint, object_id int, note_no bigint, position_note string, "
    "total_cost_diff decimal(38,2)"
)


def test_general_fund_lines_drop_other_funds_and_missing_agencies(spark):
    df = frame(spark, line(start=1), line(fund_id=2000), line(agency_id=None))
    gf = L.general_fund_lines(df)
    assert gf.count() == 1
    assert "objective_name" not in gf.columns and "justification" in gf.columns


def test_all_null_amounts_sum_to_zero_and_division_by_zero_is_null(spark):
    row = L.object_detail(L.general_fund_lines(frame(spark, line(), line()))).first()
    assert (row.amount_start, row.amount_end, row["diff"]) == (0, 0, 0)
    assert row.pct_change is None and row.pct_change_text is None


def test_percent_text(spark):
    row = L.object_detail(frame(spark, line(start=200, end=225))).first()
    assert (row["diff"], row.pct_change, row.pct_change_text) == (25, 0.125, "12.5%")


def test_employee_objects_merge_and_details_sum_to_the_same_summary(spark):
    df = frame(
        spark,
        line(obj=PAY, start=100, end=110, justification="a"),
        line(obj=PAY, start=1, end=None, justification="b"),
        line(obj=BENEFITS, start=10, end=20),
    )
    direct = L.object_summary(df)
    via_detail = L.object_summary(L.object_detail(df).select(*L.service_object_totals(df).columns))
    row = direct.first()
    assert direct.count() == 1
    assert (row.object_id, row.object_name, row["diff"]) == (1, "All Employee Costs", 19)
    assert direct.collect() == via_detail.collect()


def test_significant_needs_amount_and_share(spark):
    df = frame(
        spark,
        line(service=1, start=10000, end=16000),
        line(service=2, start=100000, end=106000),
        line(service=3, start=10, end=20),
        line(service=4, start=0, end=9000),
    )
    flags = L.significant_changes(L.object_detail(df)).select("service_id", "significant")
    assert dict(flags.collect()) == {1: "Yes", 2: "No", 3: "No", 4: "No"}


def test_grid_has_every_object_but_two_for_every_service(spark):
    df = frame(spark, line(1, PAY), line(1, BENEFITS), line(2, (0, "Transfers")), line(2, (0, "Transfer")))
    grid = sorted(map(tuple, L.object_service_grid(df).collect()))
    assert grid == [(1, 0), (1, 1), (2, 0), (2, 1)]


def test_sheet_order_labels_and_totals(spark):
    df = frame(
        spark,
        line(1, PAY, start=100, end=150),
        line(1, BENEFITS, start=10, end=5),
        line(2, (0, "Transfers"), start=7, end=7),
        line(3, (8, "Debt Service"), start=0, end=0),
    )
    note = spark.createDataFrame([(1, 1, 1, "Create Clerk position", D("9.00"))], NO_NOTE)
    totals = L.service_object_totals(L.general_fund_lines(df))
    sheet = L.full_change_sheet(totals, note)
    rows = sheet.orderBy("service_id", "section", "object_order", "note_no").collect()
    first = [(r.object_id, r.change_label, r.amount) for r in rows if r.service_id == 1 and r.note_no == 0]
    assert first == [
        (None, "FY23 Adopted Budget", 110),
        ("0", "No Transfers", None),
        ("1, 2", "Increase in All Employee Costs", 45),
        ("8", "No Debt Service", None),
        (None, "FY24 CLS Budget", 155),
    ]
    second = [r.change_label for r in rows if r.service_id == 2]
    assert second == [
        "FY23 Adopted Budget",
        "No change in Transfers",
        "No Employee Costs",
        "No Debt Service",
        "FY24 CLS Budget",
    ]
    notes = {r.automated_notes for r in rows if r.service_id == 1 and r.section == 1}
    assert "Create Clerk position at a cost of 9.00" in notes
    active = {(r.agency_name, r.service_id) for r in L.active_services(sheet).collect()}
    assert active == {("Parks", 1), ("Parks", 2)}


def test_lines_of_notes_come_after_their_row(spark):
    df = frame(spark, line(1, PAY, start=100, end=150), line(1, (3, "Contractual Services"), start=5, end=5))
    note = spark.createDataFrame(
        [(1, 1, 1, "Create A position", D(4)), (1, 1, 2, "Create B position", D(5)), (2, 1, 1, "Create C position", D(1))], NO_NOTE
    )
    flat = spark.createDataFrame(
        [(1, 1, "b", "Flat b"), (1, 1, "a", "Flat a"), (1, 3, "c", "Flat c"), (1, 2, "d", "no such row")],
        "service_id bigint, object_id int, note string, change_table_note string",
    )
    rows = L.change_rows(L.object_summary(df), note, flat).orderBy("object_id", "note_no").collect()
    assert [(r.object_id, r.note_no, r.difference, r.note_cost, r.position_note) for r in rows] == [
        (1, 0, 50, 9, ""),
        (1, 1, None, None, "Create A position"),
        (1, 2, None, None, "Create B position at a cost of 9.00"),
        (1, 3, None, None, "Flat a"),
        (1, 4, None, None, "Flat b"),
        (3, 0, 0, None, ""),
        (3, 1, None, None, "Flat c"),
    ]
    assert {r.change_label for r in rows if r.note_no} == {None}


def test_service_in_two_agencies_fans_out(spark):
    df = frame(spark, line(1, PAY, start=1), line(1, PAY, start=2, agency_id=2, agency_name="Police"))
    totals = L.service_object_totals(df)
    sheet = L.full_change_sheet(totals, spark.createDataFrame([], NO_NOTE))
    assert {r.agency_name for r in sheet.collect()} == {"Parks", "Police"}
    assert sheet.filter("section = 0").count() == 4


def test_object_rows_bridge_the_two_budgets(fx):
    """Invariant: start budget + object rows = end budget for every service."""
    gf = L.general_fund_lines(fx.budget_line)
    rows = L.object_summary(gf).groupBy("service_id").agg(F.sum("diff").alias("diff"))
    ends = L.budget_bookends(gf).groupBy("service_id").agg(
        F.expr("sum(IF(change_label LIKE 'FY24%', amount, -amount)) AS moved")
    )
    assert rows.join(ends, "service_id").filter("diff <> moved").count() == 0


def test_allow_list_appends_the_extras(spark):
    df = frame(spark, line(1), line(1), line(2))
    assert sorted(r[0] for r in L.service_allow_list(df).collect()) == ["1", "168", "2", "619", "833"]
