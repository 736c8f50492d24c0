"""Extracts of the finance tables, with the column headings of the reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasediff import constants as K
from phasediff.operators.ordering import presentation_sort
from phasediff.operators.placed import ordered_left_joins

LINE_KEYS = [
    "agency_id",
    "program_id",
    "activity_id",
    "subactivity_id",
    "fund_id",
    "detailed_fund_id",
    "object_id",
    "subobject_id",
    "objective_id",
]
# Report headings of the dimension columns.
DIMENSION_HEADINGS = {
    "agency_id": "Agency ID",
    "agency_name": "Agency Name",
    "program_id": "Program ID",
    "program_name": "Program Name",
    "activity_id": "Activity ID",
    "activity_name": "Activity Name",
    "subactivity_id": "Subactivity ID",
    "subactivity_name": "Subactivity Name",
    "fund_id": "Fund ID",
    "fund_name": "Fund Name",
    "detailed_fund_id": "Detail Fund ID",
    "detailed_fund_name": "Detail Fund Name",
    "object_id": "Object ID",
    "object_name": "Object Name",
    "subobject_id": "Subobject ID",
    "subobject_name": "Subobject Name",
    "objective_id": "Objective ID",
    "objective_name": "Objective Name",
}
# Report headings of the phase amounts of a line item.
LINE_PHASES = {
    "current_adopted": "FY22 Adopted",
    "cls_request": "FY23 CLS",
    "proposal1": "FY23 Proposal",
    "tls_request": "FY23 TLS",
    "finance_recommendation": "FY23 FinRec",
}


def headed(headings: Mapping[str, str]) -> list[Column]:
    return [F.col(name).alias(heading) for name, heading in headings.items()]


def line_detail(
    line_item_report: DataFrame, phases: Mapping[str, str] = LINE_PHASES
) -> DataFrame:
    """Every line item with its phases and its change against the adopted budget."""
    ordered = presentation_sort(line_item_report, *LINE_KEYS)
    share = F.format_number(F.col("perc_change_vs_adopted") * 100, 2)
    return ordered.select(
        *headed(DIMENSION_HEADINGS),
        *headed(phases),
        F.col("change_vs_adopted").alias("$ - Change vs Adopted"),
        share.alias("% - Change vs Adopted"),
        "justification",
    )


def line_summary(line_item_summary: DataFrame) -> DataFrame:
    """Programs by fund with a row total; a program with a missing fund has no total and drops."""
    funds = {f"fund_{i}": name for i, name in K.SUMMARY_FUNDS.items()}
    total = reduce(add, [F.col(c) for c in funds])
    kept = line_item_summary.filter(total > 0)
    keys = ["agency_id", "agency_name", "program_id", "program_name"]
    headings = {k: DIMENSION_HEADINGS[k] for k in keys} | funds
    return presentation_sort(kept, "agency_id", "program_id").select(
        *headed(headings), total.alias("Total")
    )


def line_summary_wide(lines: DataFrame, amount: str) -> DataFrame:
    """The wide fund columns from long line items; a fund without lines is 0."""
    return lines.groupBy("agency_id", "agency_name", "program_id", "program_name").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("fund_id") == i, F.col(amount))), F.lit(0)).alias(
                f"fund_{i}"
            )
            for i in K.SUMMARY_FUNDS
        ]
    )


def opc_report(all_opcs: DataFrame) -> DataFrame:
    """Position costs with the single cost codes; both cost columns show the total."""
    # Report headings of the position columns.
    headings = {
        "job_number": "JOB NUMBER",
        "class_id": "CLASSIFICATION ID",
        "union_code": "UNION ID",
        "agency": "AGENCY ID",
        "program": "PROGRAM ID",
        "activity": "ACTIVITY ID",
        "fund": "FUND ID",
        "detailed_fund": "DETAILED FUND ID",
        "special_indicator": "SI ID",
        "adopted_position": "ADOPTED",
    }
    return all_opcs.select(
        *headed(headings),
        F.col("total_cost").alias("SALARY"),
        *headed({f"opc_{code}": f"OSO {code}" for code in K.OPC_CODES}),
        F.col("total_cost").alias("TOTAL COST"),
    )


EXPENDITURE_SORT = [
    "agency_id",
    "agency_name",
    "program_id",
    "program_name",
    "activity_id",
    "activity_name",
    "fund_id",
    "fund_name",
    "object_id",
    "object_name",
    "subobject_id",
    "subobject_name",
]


def expenditure_detail(
    cur_exp: DataFrame, line_item_report: DataFrame, carry_fwd: DataFrame
) -> DataFrame:
    """Current-year spending by month with the justification and the carry-forward purpose.

    A line is repeated for each of its justifications and purposes. The lines are moved once, see `ordered_left_joins`.
    """
    line_keys = ["agency_id", "program_id", "activity_id", "fund_id", "subobject_id"]
    reasons = line_item_report.select(*line_keys, "justification")
    purposes = carry_fwd.select(*line_keys, "object_id", F.col("text").alias("purpose"))
    rights = [(reasons, line_keys), (purposes, [*line_keys, "object_id"])]
    joined = ordered_left_joins(cur_exp, rights, EXPENDITURE_SORT)
    # Report headings of the amounts.
    before = {
        "prior_adopted": "FY21 Adopted",
        "prior_actual": "FY21 Actual",
        "prior_ytd_actual": "FY21 YTD Actual",
        "curr_adopted": "FY22 Adopted",
        "carry_fwd_a": "Carry Forward - A",
        "carry_fwd_b": "Carry Forward - B",
        "carry_fwd_total": "Carry Forward - Total",
        "app_adj": "Appropriations Adjustments",
        "tot_budget": "Total Budget",
    }
    after = {
        "ytd_exp": "YTD Exp",
        "tot_enc": "Total Encumbrance",
        "cur_acc": "Current Accrual",
        "purpose": "Carry Forward Purpose",
        "justification": "Justification",
    }
    dims = {k: DIMENSION_HEADINGS[k] for k in EXPENDITURE_SORT} | {"agency_name": "Agency"}
    return joined.select(
        *headed(dims), *headed(before), *headed(K.MONTHS), *headed(after)
    )


def expenditure_by_agency_fund(lines: DataFrame) -> DataFrame:
    """Four phases by agency and fund."""
    # Report headings of the sums.
    sums = {
        "current_adopted": "Total FY22 Adopted",
        "cls_request": "Total FY23 CLS",
        "proposal1": "Total FY23 Proposal",
        "tls_request": "Total FY23 TLS",
    }
    keys = ["agency_id", "agency_name", "fund_id", "fund_name"]
    totals = lines.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
    headings = {k: DIMENSION_HEADINGS[k] for k in keys} | sums
    return presentation_sort(totals, "agency_id", "fund_id").select(*headed(headings))


def expenditure_summary(cye_summary: DataFrame) -> DataFrame:
    """All amounts by agency. The net column leaves out rows that lack budget or spending."""
    # Report headings of the sums.
    sums = {
        "prior_adopted": "FY21 Adopted",
        "prior_actual": "FY21 Actual",
        "prior_ytd_actual": "FY21 YTD Actual",
        "curr_adopted": "FY22 Adopted",
        "carry_fwd_a": "Carry Forward - A",
        "carry_fwd_b": "Carry Forward - B",
        "carry_fwd_total": "Carry Forward - Total",
        "app_adj": "AAO",
        "tot_budget": "Total Budget",
        "ytd_exp": "YTD Exp",
        "tot_enc": "Encumbrances",
        "total_spent": "Total Spent",
        "surp_def": "Surplus/Deficit",
    }
    totals = cye_summary.groupBy("agency_name").agg(
        *[F.sum(c).alias(heading) for c, heading in sums.items()],
        F.sum(F.col("tot_budget") - F.col("ytd_exp")).alias("Net Sur/Def"),
    )
    return presentation_sort(totals, "agency_name").withColumnRenamed("agency_name", "Agency")


def multi_phase_gf(lines: DataFrame, phases: Mapping[str, str]) -> DataFrame:
    """General-fund lines with the amounts of any number of phases side by side."""
    dims = [c for c in DIMENSION_HEADINGS if c in lines.columns and not c.startswith("objective")]
    return lines.filter(F.col("fund_id") == K.GENERAL_FUND_ID).select(
        *dims, *headed(phases), "justification"
    )
