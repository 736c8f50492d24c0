from decimal import Decimal as D

from pyspark.sql import functions as F

from phasediff.plans import finance, ladder, service
from phasediff.plans.service import PHASES

DIMS = (
    "agency_name string, service_name string, service_id bigint, type string, "
    "fund_name string, objective_name string"
)
SUMMARY = DIMS + "".join(f", {p} decimal(28,2)" for p in PHASES)
CLS = (
    "service_id bigint, fund_id int, fund_name string, objective_name string, "
    "subobject_id string, cls_amount decimal(18,2)"
)
PROP = (
    "agency_name string, service_id bigint, service_name string, fund_id int, fund_name string, "
    "objective_name string, subobject_id string, prior_actual decimal(18,2), "
    "adopted decimal(18,2), request decimal(18,2)"
)


def summary(spark, *rows):
    full = [("Parks", "S1", 1, *r[:2], "Youth", *map(D, r[2:])) for r in rows]
    return spark.createDataFrame(full, SUMMARY)


def test_request_side_keeps_its_keys_and_null_keys_match(spark):
    prop = spark.createDataFrame(
        [
            ("Parks", 1, "S1", 1001, "General", None, "101", D(1), D(2), D(3)),
            ("Parks", 2, "S2", 1001, "General", "Youth", "101", D(1), D(2), D(3)),
        ],
        PROP,
    )
    cls = spark.createDataFrame(
        [(1, 1001, "General", None, "101", D(7)), (3, 1001, "General", "Youth", "101", D(9))], CLS
    )
    rows = {r.service_id: r.cls for r in service.phase_line_items(cls, prop).collect()}
    assert rows == {1: D(7), 2: None}
    counts = spark.createDataFrame([], DIMS + "".join(f", {p} bigint" for p in PHASES))
    total = service.service_summary(service.phase_line_items(cls, prop), counts)
    assert {r.service_id: r.cls for r in total.collect()} == {1: D(7), 2: D(0)}


def test_drivers_bucket_general_lines_and_drop_zero_changes(spark):
    prop = spark.createDataFrame(
        [
            ("Parks", 1, "S1", 1001, "General", "Youth", s, D(1), D(a), D(3))
            for s, a in (("101", 10), ("162", 10), ("202", 4), ("999", 1), ("205", 5))
        ]
        + [("Parks", 1, "S1", 4000, "Federal", "Youth", "101", D(1), D(50), D(3))],
        PROP,
    )
    cls = spark.createDataFrame(
        [
            (1, 1001, "General", "Youth", "101", D(12)),
            (1, 1001, "General", "Youth", "162", D(13)),
            (1, 1001, "General", "Youth", "202", D(4)),
            (1, 1001, "General", "Youth", "999", D(0)),
            (1, 4000, "Federal", "Youth", "101", D(90)),
        ],
        CLS,
    )
    found = {r.bucket: r["diff"] for r in service.cost_drivers(cls, prop).collect()}
    assert found == {"Permanent Wages Adjustment": D(5), "Other": D(-1)}


def test_budget_table_rounds_and_leaves_zero_bases_open(spark):
    df = summary(
        spark,
        ("Expenditures", "General", 1, 2, 200, 225),
        ("Expenditures", "Federal", 1, 2, 0, 5),
        ("Expenditures", None, 1, 2, 5, 0),
        ("Positions", "Unlisted", 1, 2, 3, 4),
    )
    rows = {r.fund_name: r for r in service.service_budget_table(df).collect()}
    assert (rows["General"].change, rows["General"].change_pct) == (25, 12.5)
    assert rows["Federal"].change_pct is None and rows[None].change_pct is None
    assert rows["Unlisted"].change_pct == 33.3
    order = sorted(rows, key=lambda f: rows[f].fund_order)
    assert order == ["General", "Federal", None, "Unlisted"]


def test_rollup_total_is_the_sum_of_its_rows(fx, spark):
    lines = service.phase_line_items(fx.expend_cls, fx.expend_prop)
    df = service.service_summary(lines, service.phase_position_counts(**fx.pos_phases))
    for report in (service.agency_dollars_by_service, service.agency_positions_by_service):
        sums = report(df).groupBy("agency_name").agg(
            F.expr("sum(IF(is_total = 1, request, -request)) AS gap"),
            F.expr("count_if(is_total = 1) AS totals"),
        )
        assert sums.filter("gap <> 0 OR totals <> 1").count() == 0


def test_null_fund_is_not_the_total(spark):
    df = summary(spark, ("Expenditures", None, 1, 2, 3, 4), ("Expenditures", "General", 1, 2, 3, 5))
    rows = {(r.is_total, r.fund_name): r.request for r in service.agency_dollars_by_fund(df).collect()}
    assert rows == {(0, None): 4, (0, "General"): 5, (1, "Total"): 9}


def test_ladder_has_27_ordered_rows(spark):
    df = summary(
        spark,
        ("Expenditures", "General", 1, 100, 200, 300),
        ("Expenditures", "Federal", 1, 7, 7, 7),
        ("Positions", "General", 1, 2, 3, 4),
    )
    drivers = spark.createDataFrame(
        [("Parks", 1, "S1", "General", "Pension Adjustment", D(4))],
        "agency_name string, service_id bigint, service_name string, fund_name string, "
        "bucket string, diff decimal(28,2)",
    )
    rows = ladder.general_fund_ladder(df, drivers).orderBy("ladder_row").collect()
    assert [r.ladder_row for r in rows] == list(range(1, 28))
    amounts = {r.change_label: r.amount for r in rows if r.amount is not None}
    assert amounts["FY2023 Adopted"] == 100 and amounts["CLS Adjustments"] == 200
    assert amounts["Request Adjustments"] == 300 and amounts["TLS Adjustments"] == 0
    assert amounts["Updated Pension costs based on projected rate"] == 4
    assert amounts["All other updates"] == 0
    assert [r.change_label for r in rows if r.status == "Pending"] == [
        "FinRec Adjustments", "BoE Adjustments", "Council Adjustments", "FY2024 Budget",
    ]


def test_line_summary_drops_programs_with_a_missing_fund(spark):
    from phasediff.constants import SUMMARY_FUNDS

    columns = ", ".join(f"fund_{i} decimal(18,2)" for i in SUMMARY_FUNDS)
    schema = f"agency_id int, agency_name string, program_id bigint, program_name string, {columns}"
    n = len(SUMMARY_FUNDS)
    df = spark.createDataFrame(
        [
            (1, "Parks", 1, "S1", *[D(1)] * n),
            (1, "Parks", 2, "S2", None, *[D(1)] * (n - 1)),
            (1, "Parks", 3, "S3", *[D(0)] * n),
        ],
        schema,
    )
    assert [(r["Program ID"], r["Total"]) for r in finance.line_summary(df).collect()] == [(1, n)]


def test_net_sum_leaves_out_rows_with_a_missing_side(spark):
    names = (
        "prior_adopted prior_actual prior_ytd_actual curr_adopted carry_fwd_a carry_fwd_b "
        "carry_fwd_total app_adj tot_budget ytd_exp tot_enc total_spent surp_def"
    ).split()
    values = dict.fromkeys(names, 1) | {"tot_budget": 10, "ytd_exp": 4}
    rows = [("Parks", *values.values()), ("Parks", *(values | {"ytd_exp": None}).values())]
    df = spark.createDataFrame(rows, "agency_name string, " + ", ".join(f"{n} int" for n in names))
    row = finance.expenditure_summary(df).first()
    assert (row["Total Budget"], row["YTD Exp"], row["Net Sur/Def"]) == (20, 4, 6)
