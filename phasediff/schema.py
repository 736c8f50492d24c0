"""Canonical schemas and column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

BUDGET_LINE = (
    "agency_id int, agency_name string, service_id bigint, service_name string, "
    "activity_id int, activity_name string, fund_id int, fund_name string, object_id int, "
    "object_name string, subobject_id string, subobject_name string, objective_name string, "
    "amount_start decimal(18,2), amount_end decimal(18,2), justification string"
)
POSITION = (
    "job_number bigint, agency_id int, agency_name string, service_id bigint, "
    "service_name string, fund_id int, fund_name string, class_id int, class_name string, "
    "si_id string, salary decimal(18,2), total_cost decimal(18,2)"
)
SHEET_ROW = (
    "sheet string, row_no int, change_label string, c12 string, c13 string, "
    "recommendation string, c16 string, c17 string, c18 string"
)
ASSIGNMENT = (
    "agency_id int, agency_name string, agency_clean string, agency_short string, "
    "analyst string, operational boolean"
)

# Headers of the inputs that have another canonical name.
HEADER_NAMES = {
    "program_id": "service_id",
    "program_name": "service_name",
    "classification_id": "class_id",
    "classification_name": "class_name",
    "detailed_fund_id": "detail_fund_id",
    "detailed_fund_name": "detail_fund_name",
}


def canonical_name(header: str) -> str:
    """`Agency ID` -> `agency_id`; a program is a service."""
    name = re.sub(r"[^0-9a-z]+", "_", header.strip().lower()).strip("_")
    return HEADER_NAMES.get(name, name)


def canonical_columns(
    df: DataFrame, renames: dict[str, str], duplicates: tuple[str, ...] = ()
) -> DataFrame:
    """Rename all columns by position, so headers that differ only by case cannot clash.

    Two headers with one canonical name are an error unless declared; of a declared duplicate
    the first column stays.
    """
    names, dropped, seen = [], [], set()
    for i, header in enumerate(df.columns):
        name = renames.get(header, canonical_name(header))
        if name in seen:
            if name not in duplicates:
                raise ValueError(f"two columns are called {name!r}: {df.columns}")
            name = f"{name}__{i}"
            dropped.append(name)
        seen.add(name)
        names.append(name)
    return df.toDF(*names).drop(*dropped)


def phase_columns_as_dollars(df: DataFrame) -> DataFrame:
    """`fy23_budget` and `fy22_actual` -> `fy23_dollars`, `fy22_dollars`."""
    return df.toDF(*[re.sub("(?i)budget|actual", "dollars", c) for c in df.columns])
