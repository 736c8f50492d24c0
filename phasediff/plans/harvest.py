"""Reading completed sheets back: adjustments, savings ideas and the ladder by pillar.

Input is one row per sheet row: file_path, sheet, row_no, change_label, c12, c13, recommendation,
c16, c17, c18 (all text but the number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phasediff import constants as K
from phasediff.operators.joins import lookup_join
from phasediff.sources.files import sheet_keys

SHEET = ["file_path", "sheet"]


def _block(rows: DataFrame, title: str, nth_total: int) -> DataFrame:
    """Rows of a sheet from a title row to its n-th total row, both included.

    Only the few marker rows are grouped. The n-th total is found with a row number that Spark
    cuts off before the shuffle, and the bounds are joined to the rows, so a source that holds a
    large share of all rows is never brought together in one task.
    """
    keyed = sheet_keys(rows)
    mark = F.col("recommendation")
    titles = keyed.filter(mark == title).groupBy(*SHEET).agg(F.min("row_no").alias("_first"))
    nth = F.row_number().over(Window.partitionBy(*SHEET).orderBy("row_no"))
    totals = (
        keyed.filter(mark == K.TOTAL_MARKER)
        .select(*SHEET, "row_no")
        .withColumn("_nth", nth)
        .filter(F.col("_nth") <= nth_total)
        .groupBy(*SHEET)
        .agg(F.min(F.when(F.col("_nth") == nth_total, F.col("row_no"))).alias("_last"))
        .filter(F.col("_last").isNotNull())
    )
    bounds = titles.join(totals, SHEET)
    low = F.least("_first", "_last")
    high = F.greatest("_first", "_last")
    joined = lookup_join(keyed, bounds, SHEET)
    return joined.filter(F.col("row_no").between(low, high)).drop("_first", "_last")


def technical_block(rows: DataFrame) -> DataFrame:
    """From the technical title to the first total; a sheet without either has no block."""
    return _block(rows, K.TECHNICAL_TITLE, 1)


def savings_block(rows: DataFrame) -> DataFrame:
    """From the savings title to the second total."""
    return _block(rows, K.SAVINGS_TITLE, 2)


def _entries(block: DataFrame, title: str) -> DataFrame:
    text = F.col("recommendation")
    return block.filter(text.isNotNull() & ~text.isin(*K.PLACEHOLDERS, title)).select(
        "service_id",
        "agency",
        text.alias("adjustment"),
        F.col("c16").alias("object"),
        F.col("c17").alias("subobject"),
        F.col("c18").alias("amount"),
    )


def technical_adjustments(block: DataFrame) -> DataFrame:
    return _entries(block, K.TECHNICAL_TITLE)


def savings_ideas(block: DataFrame) -> DataFrame:
    return _entries(block, K.SAVINGS_TITLE)


def service_coverage(entries: DataFrame) -> DataFrame:
    """How many services have at least one entry."""
    return entries.agg(F.count_distinct("service_id").alias("services"))


def ladder_rows(rows: DataFrame) -> DataFrame:
    """The ladder part of every sheet, in sheet order by `row_no`."""
    return (
        sheet_keys(rows)
        .filter(F.col("change_label").isNotNull())
        .select(
            "agency",
            "service_id",
            "row_no",
            "change_label",
            F.col("c12").alias("amount"),
            F.col("c13").alias("decision"),
        )
    )


def pillar_map(expenditures: DataFrame) -> DataFrame:
    return expenditures.select("service_id", "service_name", "objective_name").distinct()


def _service_number() -> Column:
    return F.col("service_id").try_cast("bigint")


def ladder_with_pillar(ladder: DataFrame, pillars: DataFrame) -> DataFrame:
    """Name the pillar and the service of each ladder row."""
    named = pillars.select(
        F.col("service_id").cast("bigint").alias("_service"),
        F.col("objective_name").alias("pillar"),
        F.col("service_name").alias("service"),
    )
    return lookup_join(ladder.withColumn("_service", _service_number()), named, ["_service"], "left").drop(
        "_service"
    )


def pillar_list(ladder: DataFrame) -> DataFrame:
    """The pillars that occur, sorted; a missing pillar is none."""
    return ladder.select("pillar").filter(F.col("pillar").isNotNull()).distinct().orderBy("pillar")


def pillar_book(ladder: DataFrame) -> DataFrame:
    """Decided rows by pillar and agency with numeric amounts.

    Rows without an amount drop out with the pending ones; a repeated header row stays and has
    no number.
    """
    return ladder.filter(
        F.col("pillar").isNotNull()
        & (F.col("amount") != K.PENDING)
        & (F.col("change_label") != K.TLS_LABEL)
    ).select(
        "pillar",
        "agency",
        "service_id",
        "row_no",
        "change_label",
        F.col("amount").try_cast("double").alias("amount"),
        "decision",
    )


def measures_by_pillar(
    measures: DataFrame, pillars: DataFrame, dropped: str = "extra_pm_table"
) -> DataFrame:
    """Performance measures with the pillar of their service, one internal column left out."""
    joined = lookup_join(measures, pillars, ["service_id"], "left")
    kept = joined.filter(F.col("objective_name").isNotNull()).drop(dropped)
    first = ["agency_clean", "service_id"]
    return kept.select(*first, *[c for c in kept.columns if c not in first])
