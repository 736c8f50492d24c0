"""The ladder of a service: from the adopted budget to the final one in 27 labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasediff import constants as K
from phasediff.functions.columns import sum0
from phasediff.plans.service import EXPENDITURES

BLANK = "blank"

# Label and content of each row, in order. The content is the name of an amount,
# `K.PENDING`, or BLANK. The first and last label name fiscal years and come from the caller.
LADDER_ROWS = (
    ("{start}", "adopted"),
    ("CLS Adjustments", "cls"),
    ("Permanent Wages Adjustment", "Permanent Wages Adjustment"),
    ("Updated Pension costs based on projected rate", "Pension Adjustment"),
    ("Updated healthcare costs based on projected rate", "Healthcare Adjustment"),
    ("All other benefit updates", BLANK),
    ("Updated Fleet rate", "Fleet Adjustment"),
    (
        "Updated Building/Maintenance/Rental Charges",
        "Building Maintenance and Rental Charge Adjustment",
    ),
    ("All other updates", "Other"),
    ("Build-ins/Build-outs (please list)", BLANK),
    ("", BLANK),
    ("Request Adjustments", "request"),
    ("", BLANK),
    ("", BLANK),
    ("TLS Adjustments", "tls"),
    ("", BLANK),
    ("", BLANK),
    ("FinRec Adjustments", K.PENDING),
    ("", BLANK),
    ("", BLANK),
    ("BoE Adjustments", K.PENDING),
    ("", BLANK),
    ("", BLANK),
    ("Council Adjustments", K.PENDING),
    ("", BLANK),
    ("", BLANK),
    ("{final}", K.PENDING),
)


def general_fund_ladder(
    summary: DataFrame,
    drivers: DataFrame,
    start_label: str = "FY2023 Adopted",
    final_label: str = "FY2024 Budget",
) -> DataFrame:
    """27 rows per agency and service; `ladder_row` keeps their order.

    The amounts of a service become one wide row first, which then turns into the 27 rows.
    An amount stands in `amount`; a pending decision in `status`. The rows called "Adjustments"
    hold the total of the phase.
    """
    general = (F.col("type") == EXPENDITURES) & (F.col("fund_name") == K.GENERAL_FUND_NAME)
    totals = summary.groupBy("agency_name", "service_id").agg(
        *[
            sum0(F.when(general, F.col(c))).alias(c)
            for c in ("adopted", "cls", "request")
        ],
        F.lit(0).alias("tls"),
    )
    buckets = [*K.DRIVER_BUCKETS, K.OTHER_DRIVERS]
    of_service = (
        drivers.filter(F.col("fund_name") == K.GENERAL_FUND_NAME)
        .groupBy("service_id")
        .agg(*[sum0(F.when(F.col("bucket") == b, F.col("diff"))).alias(b) for b in buckets])
    )
    wide = totals.join(of_service, "service_id", "left").na.fill(0, subset=buckets)
    names = {"{start}": start_label, "{final}": final_label}
    rows = [
        F.struct(
            F.lit(i).alias("ladder_row"),
            F.lit(names.get(label, label)).alias("change_label"),
            _amount(content).alias("amount"),
            F.lit(K.PENDING if content == K.PENDING else "").alias("status"),
            F.lit("").alias("decision"),
        )
        for i, (label, content) in enumerate(LADDER_ROWS, start=1)
    ]
    return wide.select("agency_name", "service_id", F.inline(F.array(*rows)))


def _amount(content: str) -> Column:
    value = F.lit(None) if content in (BLANK, K.PENDING) else F.col(f"`{content}`")
    return value.cast("decimal(38,2)")
