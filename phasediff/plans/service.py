"""Four phases of a service: budget tables, cost drivers and agency roll-ups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasediff import constants as K
from phasediff.functions.columns import lookup, position_in, sql_literal, sum0, zero_filled
from phasediff.operators.joins import null_safe_join

PHASES = ["prior_actual", "adopted", "cls", "request"]
SUMMARY_KEYS = [
    "agency_name",
    "service_name",
    "service_id",
    "type",
    "fund_name",
    "objective_name",
]
EXPENDITURES = "Expenditures"
POSITIONS = "Positions"
TOTAL = "Total"


def operational_agencies(assignments: DataFrame, require_analyst: bool = True) -> DataFrame:
    """Agencies that get a report; the sheet export also serves those without an analyst."""
    chosen = assignments.filter(F.col("operational"))
    if require_analyst:
        chosen = chosen.filter(F.col("analyst").isNotNull())
    return chosen.withColumn("agency_id", F.col("agency_id").cast("string")).distinct()


def phase_line_items(cls: DataFrame, prop: DataFrame) -> DataFrame:
    """Request-side amounts by agency, service, fund and objective, with the CLS amount beside.

    Keys that only CLS knows drop out. Both sides are aggregated to the join key or finer before
    they meet, so the join never multiplies rows.
    """
    on = ["service_id", "fund_id", "objective_name"]
    requested = prop.groupBy(
        "agency_name", "service_id", "service_name", "fund_id", "fund_name", "objective_name"
    ).agg(*[sum0(c).alias(c) for c in ("prior_actual", "adopted", "request")])
    current = cls.groupBy(*on).agg(sum0("cls_amount").alias("cls"))
    return null_safe_join(requested, current, on).select(
        "agency_name",
        "service_id",
        "service_name",
        "fund_id",
        "fund_name",
        "objective_name",
        *PHASES,
    )


def phase_position_counts(
    planning: DataFrame, cls: DataFrame, projection: DataFrame, prior: DataFrame
) -> DataFrame:
    """Jobs by agency, service and fund in four snapshots; only keys of the planning one stay."""
    keys = ["agency_name", "service_name", "service_id", "fund_name"]
    snapshots = {"request": planning, "cls": cls, "adopted": projection, "prior_actual": prior}
    tagged = [df.select(*keys, F.lit(p).alias("phase")) for p, df in snapshots.items()]
    stacked = reduce(DataFrame.unionByName, tagged)
    counts = stacked.groupBy(*keys).agg(
        *[F.nullif(F.count_if(F.col("phase") == p), F.lit(0)).alias(p) for p in PHASES]
    )
    return counts.filter(F.col("request").isNotNull()).withColumns(
        {"objective_name": F.lit(""), "type": F.lit(POSITIONS)}
    )


def service_summary(lines: DataFrame, counts: DataFrame) -> DataFrame:
    """Dollars and jobs of four phases by service, type, fund and objective."""
    dollars = lines.withColumn("type", F.lit(EXPENDITURES)).select(*SUMMARY_KEYS, *PHASES)
    stacked = zero_filled(dollars.unionByName(counts.select(*dollars.columns)), PHASES)
    return stacked.groupBy(*SUMMARY_KEYS).agg(*[F.sum(c).alias(c) for c in PHASES])


def service_row_counts(summary: DataFrame) -> DataFrame:
    return summary.groupBy("agency_name", "service_id").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def driver_bucket(subobject: str) -> Column:
    codes = {ids: bucket for bucket, ids in K.DRIVER_BUCKETS.items()}
    return lookup(subobject, codes, sql_literal(K.OTHER_DRIVERS))


def cost_drivers(cls: DataFrame, prop: DataFrame) -> DataFrame:
    """What moves the general-fund budget from adopted to CLS, by kind of cost."""
    on = ["service_id", "fund_id", "subobject_id"]
    requested = (
        prop.filter(F.col("fund_name") == K.GENERAL_FUND_NAME)
        .groupBy(
            "agency_name", "service_id", "service_name", "fund_id", "fund_name", "subobject_id"
        )
        .agg(sum0("adopted").alias("adopted"), sum0("request").alias("request"))
    )
    current = (
        cls.filter(F.col("fund_id") == K.GENERAL_FUND_ID)
        .groupBy(*on)
        .agg(sum0("cls_amount").alias("cls"))
    )
    joined = null_safe_join(requested, current, on).withColumns(
        {"bucket": driver_bucket("subobject_id"), "diff": F.col("cls") - F.col("adopted")}
    )
    return (
        joined.groupBy("agency_name", "service_id", "service_name", "fund_name", "bucket")
        .agg(*[sum0(c).alias(c) for c in ("adopted", "cls", "request", "diff")])
        .filter(F.col("diff") != 0)
    )


def service_cost_drivers(drivers: DataFrame) -> DataFrame:
    """Drivers of a service by bucket, whatever their fund label."""
    return (
        drivers.filter(F.col("fund_name") == K.GENERAL_FUND_NAME)
        .groupBy("agency_name", "service_id", "service_name", "bucket")
        .agg(*[sum0(c).alias(c) for c in ("adopted", "cls", "request", "diff")])
    )


def service_budget_table(summary: DataFrame) -> DataFrame:
    """The table at the top of a service sheet; `fund_order` is the display order of funds."""
    change = F.col("request") - F.col("cls")
    ratio = F.try_divide(change.cast("double"), F.col("cls").cast("double")) * 100
    untold = (F.col("request") == 0) | (F.col("cls") == 0)
    return summary.select(
        "agency_name",
        "service_id",
        "service_name",
        "type",
        "fund_name",
        "objective_name",
        *PHASES,
        F.lit(0).alias("tls"),
        change.alias("change"),
        F.when(untold, F.lit(None)).otherwise(F.bround(ratio, 1)).alias("change_pct"),
        position_in("fund_name", K.FUND_ORDER).alias("fund_order"),
    )


def _rollup_by(summary: DataFrame, type_: str, label: str) -> DataFrame:
    """Sums by agency and label with a total row per agency."""
    rolled = (
        summary.filter(F.col("type") == type_)
        .groupBy("agency_name", label)
        .agg(*[F.sum(c).alias(c) for c in PHASES])
        # the fine sums are small, so the total row is expanded from them and not from all rows
        .withColumn("_level", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn(label, F.when(F.col("_level") == 0, F.col(label)).otherwise(F.lit(TOTAL)))
        .groupBy("agency_name", "_level", label)
        .agg(*[F.sum(c).alias(c) for c in PHASES])
    )
    return rolled.withColumn("change", F.col("request") - F.col("cls")).withColumnRenamed(
        "_level", "is_total"
    )


def _service_label(summary: DataFrame) -> DataFrame:
    return summary.withColumn(
        "service", F.concat_ws(": ", F.col("service_id").cast("string"), F.col("service_name"))
    )


def agency_dollars_by_service(summary: DataFrame) -> DataFrame:
    return _rollup_by(_service_label(summary), EXPENDITURES, "service")


def agency_positions_by_service(summary: DataFrame) -> DataFrame:
    return _rollup_by(_service_label(summary), POSITIONS, "service")


def agency_dollars_by_fund(summary: DataFrame) -> DataFrame:
    return _rollup_by(summary, EXPENDITURES, "fund_name")
