"""Analyst notes carried from one round of sheets to the next, and flat adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff import constants as K
from phasediff.functions.columns import sum0
from phasediff.sources.files import sheet_keys

NOTE_KEYS = ["agency_name", "service_id", "object_id"]


def analyst_notes(rows: DataFrame, prefix: str = "Change Table_") -> DataFrame:
    """Notes of earlier sheets in one table; the agency comes from the file name."""
    return sheet_keys(rows, prefix).select(
        F.col("agency").alias("agency_name"),
        F.col("service_id").cast("bigint").alias("service_id"),
        "object_id",
        "analyst_notes",
    )


def notes_gaps(notes: DataFrame, sheets: DataFrame, gf: DataFrame) -> DataFrame:
    """Services with a sheet that are not in the general fund, and sheets missing from the stack."""
    in_sheets = sheets.select("service_id").distinct()
    funded = gf.select("service_id").distinct()
    stacked = notes.select("service_id").distinct()
    unfunded = in_sheets.join(funded, "service_id", "left_anti").select(
        "service_id", F.lit("not in general fund").alias("gap")
    )
    unread = in_sheets.join(stacked, "service_id", "left_anti").select(
        "service_id", F.lit("missing from notes").alias("gap")
    )
    return unfunded.unionByName(unread)


def carry_forward_notes(sheet: DataFrame, notes: DataFrame) -> DataFrame:
    """Put the earlier notes on each row; rows without an object (the totals) have none.

    A row with several different notes is repeated, once for each; equal notes count once. Lines of
    a position note are no rows of their own: the earlier note stands on the row above them.
    """
    earlier = (
        notes.filter(F.col("object_id").isNotNull() & F.col("analyst_notes").isNotNull())
        .select(*NOTE_KEYS, F.col("analyst_notes").alias("_earlier"))
        .distinct()
    )
    on = [*NOTE_KEYS, "note_no"] if "note_no" in sheet.columns else NOTE_KEYS
    earlier = earlier.withColumn("note_no", F.lit(0)) if len(on) > len(NOTE_KEYS) else earlier
    return sheet.join(earlier, on, "left").withColumn(
        "analyst_notes", F.coalesce("_earlier", "analyst_notes")
    ).drop("_earlier")


def flat_adjustments(adjustments: DataFrame) -> DataFrame:
    """Adjustments to show, summed by service, object and note, with their sentence."""
    totals = (
        adjustments.filter(F.col("include") == "Yes")
        .groupBy("service_id", "object_id", "note")
        .agg(sum0("amount").alias("amount"))
    )
    sentence = F.concat(
        F.lit("Flat adjustment: "),
        F.coalesce("note", F.lit("NA")),
        F.lit(" at a cost of "),
        F.col("amount").cast("string"),
    )
    return totals.withColumn("change_table_note", sentence)


def phase_sequence(
    start: tuple[int, str], end: tuple[int, str], order: tuple[str, ...] = K.PHASE_ORDER
) -> list[str]:
    """Names of the phase columns from one phase to a later one of the same fiscal year.

    >>> phase_sequence((24, "CLS"), (24, "TLS"))
    ['FY24 CLS', 'FY24 Proposal', 'FY24 TLS']
    """
    (start_year, start_phase), (end_year, end_phase) = start, end
    if start_year != end_year:
        raise ValueError("phases of different fiscal years have no common sequence")
    first, last = order.index(start_phase), order.index(end_phase)
    if first > last:
        raise ValueError(f"{end_phase} comes before {start_phase}")
    return [f"FY{start_year} {name}" for name in order[first : last + 1]]
