"""Line items of two phases: roll-ups by object and the assembled change sheet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasediff import constants as K
from phasediff.functions.columns import lookup, percent_text, share, sum0
from phasediff.operators.joins import lookup_join
from phasediff.operators.ordinals import numbered_within

SERVICE = ["agency_id", "agency_name", "service_id", "service_name"]
AMOUNTS = ["amount_start", "amount_end"]


@dataclass(frozen=True)
class PhaseLabels:
    """Names of the two phases, used only in output labels."""

    start: str = "FY23 Adopted"
    end: str = "FY24 CLS"

    @property
    def start_budget(self) -> str:
        return f"{self.start} Budget"

    @property
    def end_budget(self) -> str:
        return f"{self.end} Budget"


def service_allow_list(appropriations: DataFrame, extra=K.EXTRA_SERVICES) -> DataFrame:
    """Services that occur in the appropriation file, plus a few that never do."""
    spark = appropriations.sparkSession
    listed = (
        appropriations.select("agency_name", "service_id")
        .distinct()
        .select(F.col("service_id").cast("string").alias("service_id"))
    )
    return listed.unionByName(spark.createDataFrame([(s,) for s in extra], "service_id string"))


def general_fund_lines(lines: DataFrame) -> DataFrame:
    dims = [c for c in lines.columns if c not in (*AMOUNTS, "objective_name", "justification")]
    return lines.filter(
        (F.col("fund_id") == K.GENERAL_FUND_ID) & F.col("agency_id").isNotNull()
    ).select(*dims, *AMOUNTS, "justification")


def object_detail(gf: DataFrame) -> DataFrame:
    """Both amounts by service, object and justification, with change and percent change."""
    keys = [*SERVICE, "object_id", "object_name", "justification"]
    totals = gf.groupBy(*keys).agg(*[sum0(c).alias(c) for c in AMOUNTS])
    ratio = share(F.col("diff"), F.col("amount_start"))
    return totals.withColumn("diff", F.col("amount_end") - F.col("amount_start")).withColumns(
        {"pct_change": ratio, "pct_change_text": percent_text(ratio)}
    )


def service_object_totals(gf: DataFrame) -> DataFrame:
    """The one aggregate every part of the change sheet can be derived from."""
    return gf.groupBy(*SERVICE, "object_id", "object_name").agg(
        *[sum0(c).alias(c) for c in AMOUNTS]
    )


def object_summary(totals: DataFrame) -> DataFrame:
    """Amounts by service and object with both employee objects merged into one.

    Works on general-fund lines, on `object_detail` and on `service_object_totals` alike, since
    sums of sums are the same; from lines it never reads the justification text.
    """
    merged = totals.withColumns(
        {
            "object_id": F.when(
                F.col("object_id").isin(*K.EMPLOYEE_OBJECT_IDS), F.lit(K.EMPLOYEE_OBJECT_ID)
            ).otherwise(F.col("object_id")),
            "object_name": F.when(
                F.col("object_name").isin(*K.EMPLOYEE_OBJECT_NAMES),
                F.lit(K.EMPLOYEE_OBJECT_LABEL),
            ).otherwise(F.col("object_name")),
        }
    )
    sums = service_object_totals(merged)
    return sums.withColumn("diff", F.col("amount_end") - F.col("amount_start"))


def significant_changes(detail: DataFrame) -> DataFrame:
    """Flag changes that are large both in amount and in proportion."""
    large = (F.abs("diff") > K.SIGNIFICANT_AMOUNT) & (
        F.abs("pct_change") >= K.SIGNIFICANT_SHARE
    )
    return detail.withColumn("significant", F.when(large, F.lit("Yes")).otherwise(F.lit("No")))


def budget_bookends(gf: DataFrame, labels: PhaseLabels = PhaseLabels()) -> DataFrame:
    """Total budget of each service before and after, one row per phase.

    The lines are summed first; only the sums of the services are unpivoted.
    """
    sums = gf.groupBy(*SERVICE).agg(
        sum0("amount_start").alias(labels.start_budget), sum0("amount_end").alias(labels.end_budget)
    )
    return sums.unpivot(SERVICE, [labels.start_budget, labels.end_budget], "change_label", "amount")


def object_service_grid(gf: DataFrame) -> DataFrame:
    """Every service with every object that occurs anywhere (the merged object 2 left out).

    The distinct objects are the chart of accounts, a handful of codes; they reach the services
    as one array value instead of through a cross join.
    """
    objects = gf.filter(F.col("object_id") != 2).agg(
        F.sort_array(F.collect_set("object_id")).alias("ids")
    )
    services = gf.select("service_id").distinct()
    return services.select("service_id", F.explode(objects.scalar()).alias("object_id"))


NOTE_KEYS = ["service_id", "object_id"]


def note_totals(note: DataFrame) -> DataFrame:
    """Lines and cost of the position note of each service and object."""
    return note.groupBy(*NOTE_KEYS).agg(
        F.max("note_no").alias("note_lines"), sum0("total_cost_diff").alias("note_cost")
    )


def object_rows(summary: DataFrame, note: DataFrame) -> DataFrame:
    """One labelled row per service and object; `note_cost` is what its position note adds up to."""
    labelled = summary.select(
        *NOTE_KEYS, change_label(F.col("diff"), F.col("object_name")).alias("change_label"), "diff"
    )
    rows = labelled.groupBy(*NOTE_KEYS, "change_label").agg(sum0("diff").alias("difference"))
    totals = note_totals(note).drop("note_lines")
    return rows.join(totals, NOTE_KEYS, "left").select(
        *NOTE_KEYS,
        F.lit(0).cast("bigint").alias("note_no"),
        "change_label",
        F.lit("").alias("position_note"),
        "difference",
        "note_cost",
        F.lit("").alias("analyst_notes"),
    )


def note_lines(summary: DataFrame, note: DataFrame, adjustments: DataFrame | None = None) -> DataFrame:
    """Lines of the notes of those services and objects that have a row, numbered from 1 on.

    The last line of a position note tells its cost. The sentences of flat adjustments come after it
    and go on counting, ordered by their note.
    """
    totals = note_totals(note)
    told = lookup_join(note.select(*NOTE_KEYS, "note_no", "position_note"), totals, NOTE_KEYS)
    closing = F.concat("position_note", F.lit(" at a cost of "), F.col("note_cost").cast("string"))
    last = F.col("note_no") == F.col("note_lines")
    lines = told.select(
        *NOTE_KEYS, "note_no", F.when(last, closing).otherwise(F.col("position_note")).alias("position_note")
    )
    if adjustments is not None:
        flat = adjustments.select(*NOTE_KEYS, "note", F.col("change_table_note").alias("position_note"))
        own = numbered_within(flat, NOTE_KEYS, ["note"], "_no")
        after = lookup_join(own, totals, NOTE_KEYS, "left")
        lines = lines.unionByName(
            after.select(
                *NOTE_KEYS,
                (F.col("_no") + F.coalesce("note_lines", F.lit(0))).alias("note_no"),
                "position_note",
            )
        )
    shown = lookup_join(lines, summary.select(*NOTE_KEYS).distinct(), NOTE_KEYS)
    return shown.select(*NOTE_KEYS, "note_no", "position_note")


def change_rows(
    summary: DataFrame, note: DataFrame, adjustments: DataFrame | None = None
) -> DataFrame:
    """A labelled row per service and object (`note_no` 0), then a row per line of its note.

    Only the first has a label and amounts, so sums over all rows stay right.
    """
    return object_rows(summary, note).unionByName(
        note_lines(summary, note, adjustments), allowMissingColumns=True
    )


def change_label(diff: Column, name: Column) -> Column:
    return (
        F.when(diff > 0, F.concat(F.lit("Increase in "), name))
        .when(diff < 0, F.concat(F.lit("Decrease in "), name))
        .when(diff == 0, F.concat(F.lit("No change in "), name))
        .otherwise(name)
    )


def change_rows_dense(grid: DataFrame, rows: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Add a row for each object a service has no lines for; its label is still NULL.

    Lines of notes always stand below a row, so they need no join with the grid and are passed apart.
    """
    dense = grid.join(rows, NOTE_KEYS, "full_outer")
    return dense if lines is None else dense.unionByName(lines, allowMissingColumns=True)


def change_sheet(
    bookends: DataFrame, dense: DataFrame, labels: PhaseLabels = PhaseLabels()
) -> DataFrame:
    """Start budget, object rows with their notes, end budget.

    `section`, `object_id` and `note_no` keep that order.
    """
    ends = {0: labels.start_budget, 2: labels.end_budget}
    number = F.coalesce(F.col("note_no"), F.lit(0))
    label = F.coalesce(F.col("change_label"), lookup("object_id", K.NO_LINES_LABELS))
    objects = dense.select(
        "service_id",
        F.lit(1).alias("section"),
        "object_id",
        number.alias("note_no"),
        F.when(number == 0, label).alias("change_label"),
        F.col("difference").alias("amount"),
        "note_cost",
        F.col("position_note").alias("automated_notes"),
        "analyst_notes",
    )
    budget = bookends.filter(F.col("change_label").isin(*ends.values())).select(
        "service_id",
        lookup("change_label", {v: k for k, v in ends.items()}).alias("section"),
        F.lit(0).cast("bigint").alias("note_no"),
        "change_label",
        "amount",
    )
    return budget.unionByName(objects, allowMissingColumns=True)


def change_sheet_by_agency(sheet: DataFrame, gf: DataFrame) -> DataFrame:
    """Attach the agencies of each service and show the merged object as it is known."""
    agencies = gf.select("agency_name", "service_id").distinct()
    shown = F.when(
        F.col("object_id") == K.EMPLOYEE_OBJECT_ID, F.lit(K.EMPLOYEE_OBJECT_DISPLAY)
    ).otherwise(F.col("object_id").cast("string"))
    return (
        sheet.join(agencies, "service_id", "left")
        .withColumns({"object_order": F.col("object_id"), "object_id": shown})
    )


def active_services(sheet: DataFrame) -> DataFrame:
    """Services of an agency with any amount other than 0."""
    return (
        sheet.groupBy("agency_name", "service_id")
        .agg(F.bool_or(F.col("amount") != 0).alias("active"))
        .filter("active")
        .drop("active")
    )


def full_change_sheet(
    totals: DataFrame,
    note: DataFrame,
    labels: PhaseLabels = PhaseLabels(),
    adjustments: DataFrame | None = None,
) -> DataFrame:
    """The whole change sheet from `service_object_totals`, the position notes and flat adjustments.

    Several branches read `totals`; pass a materialised table when its input is large.
    """
    return change_sheet_by_agency(_sheet(totals, note, labels, adjustments), totals)


def _sheet(totals: DataFrame, note: DataFrame, labels: PhaseLabels, adjustments: DataFrame | None) -> DataFrame:
    summary = object_summary(totals)
    told = note_lines(summary, note, adjustments)
    dense = change_rows_dense(object_service_grid(totals), object_rows(summary, note), told)
    return change_sheet(budget_bookends(totals, labels), dense, labels)


def services_with_amounts(totals: DataFrame) -> DataFrame:
    """What `active_services` finds in the change sheet, from the totals alone: no notes, no positions."""
    summary = object_summary(totals).withColumn("change_label", change_label(F.col("diff"), F.col("object_name")))
    rows = summary.groupBy("service_id", "object_id", "change_label").agg(sum0("diff").alias("amount"))
    budgets = budget_bookends(totals).select("service_id", "amount")
    amounts = rows.select("service_id", "amount").unionByName(budgets)
    active = amounts.filter("amount <> 0").select("service_id").distinct()
    agencies = totals.select("agency_name", "service_id").distinct()
    return agencies.join(active, "service_id", "left_semi").select("agency_name", "service_id")
