"""Report outputs: one partitioned write per report, no loop over agencies or services."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phasediff.plans import ladder, lines, service
from phasediff.sources.files import setting

#: Folders that a task writes side by side; rows for more of them are sorted by folder first.
OPEN_FOLDERS = 32


def export_name(
    folder: str, stem: str, start: str, end: str, run_date: dt.date | None = None
) -> str:
    """Output path stamped with both phases and the date of the run."""
    day = (run_date or dt.date.today()).isoformat()
    name = f"{stem}_{start}-{end}_{day}".replace(" ", "")
    return f"{folder.rstrip('/')}/{name}"


def agency_key(df: DataFrame, column: str = "agency_name") -> DataFrame:
    """Agency names as they appear in output paths: `&` reads `and`."""
    return df.withColumn("agency", F.replace(F.col(column), F.lit("&"), F.lit("and")))


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """The whole table as one output, however many files that takes."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def write_by(
    df: DataFrame,
    path: str,
    partitions: list[str],
    order: list[str],
    fmt: str = "parquet",
    whole: bool = False,
) -> str:
    """One folder per partition value with rows in order.

    Only the folders that have rows in `df` are replaced, when all of them are written: a rerun for one
    agency leaves the others, and a failed rerun leaves what was there. `whole` replaces all folders.

    Range partitioning by folder and order keeps the files of a folder consecutive and few, and
    splits a folder that holds a large share of the rows over several tasks. The number of the
    task that produced a row is the last key, so that rows with equal keys can be split as well.
    """
    keys = [*partitions, *order, "_tie"]
    ranged = df.withColumn("_tie", F.spark_partition_id()).repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(*keys).drop("_tie")
    writer = ordered.write.mode("overwrite").partitionBy(*partitions).format(fmt)
    writer.option("partitionOverwriteMode", "static" if whole else "dynamic").save(path)
    return path


def write_versions(fact: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A fact with a `phase` column, stored as one folder per phase; other phases stay as they are.

    There are few phases, so a task keeps a file open for each, where Spark would sort its rows by folder.
    """
    writer = fact.write.mode("overwrite").partitionBy("phase").format(fmt)
    with setting(fact.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FOLDERS)):
        writer.option("partitionOverwriteMode", "dynamic").save(path)
    return path


def export_change_sheets(
    sheet: DataFrame,
    assignments: DataFrame,
    path: str,
    by_service: bool = False,
    fmt: str = "parquet",
) -> str:
    """Sheets of operational agencies, services without any amount left out.

    A folder per agency with its services in order; `by_service` adds a folder per service.
    """
    agencies = (
        service.operational_agencies(assignments, require_analyst=False)
        .select("agency_name", "agency_short")
        .distinct()
    )
    active = lines.active_services(sheet)
    chosen = sheet.join(active, ["agency_name", "service_id"], "left_semi").join(
        agencies, "agency_name"
    )
    folders = ["agency", "service_id"] if by_service else ["agency"]
    order = ["section", "object_order", "note_no", "change_label"]
    if not by_service:
        order.insert(0, "service_id")
    return write_by(agency_key(chosen), path, folders, order, fmt)


def export_service_tables(
    summary: DataFrame,
    drivers: DataFrame,
    assignments: DataFrame,
    path: str,
    fmt: str = "parquet",
    only: tuple[str, ...] | None = None,
) -> dict[str, str]:
    """Budget table, ladder and the three agency roll-ups of every operational agency.

    All five reports read `summary`; pass a materialised table when its input is large. `only` names the
    reports to write.
    """
    agencies = (
        service.operational_agencies(assignments).select("agency_name", "agency_clean").distinct()
    )
    reports = {
        "budget_table": (
            service.service_budget_table(summary),
            ["service_id", "type", "fund_order", "fund_name", "objective_name"],
        ),
        "ladder": (
            ladder.general_fund_ladder(summary, drivers),
            ["service_id", "ladder_row"],
        ),
        "dollars_by_service": (
            service.agency_dollars_by_service(summary),
            ["is_total", "service"],
        ),
        "positions_by_service": (
            service.agency_positions_by_service(summary),
            ["is_total", "service"],
        ),
        "dollars_by_fund": (
            service.agency_dollars_by_fund(summary),
            ["is_total", "fund_name"],
        ),
    }
    written = {}
    for name, (report, order) in reports.items():
        if only is not None and name not in only:
            continue
        chosen = agency_key(report.join(agencies, "agency_name"))
        written[name] = write_by(chosen, f"{path}/{name}", ["agency"], order, fmt)
    return written


def export_pillar_book(book: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A folder per pillar and agency with the ladder rows in sheet order."""
    return write_by(book, path, ["pillar", "agency"], ["service_id", "row_no"], fmt)


def export_measures(measures: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A folder per pillar."""
    named = measures.withColumn("pillar", F.col("objective_name"))
    return write_by(named, path, ["pillar"], ["agency_clean", "service_id"], fmt)
