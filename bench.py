"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 3, the median counts after one warm-up), BENCH_QUERIES (comma list, default below).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from pyspark.sql import SparkSession

from phasediff.verify.queries import registered

HEADLINE = (
    "object_detail",
    "object_summary",
    "budget_bookends",
    "object_service_grid",
    "change_sheet_by_agency",
    "active_services",
    "position_changes",
    "position_detail",
    "position_summary",
    "position_note",
    "service_summary",
    "cost_drivers",
    "service_budget_table",
    "general_fund_ladder",
    "agency_dollars_by_service",
    "technical_adjustments",
    "savings_ideas",
    "pillar_book",
    "line_detail",
    "line_summary",
    "expenditure_detail",
    "expenditure_summary",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("phasediff-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(run, spark: SparkSession, folder: str) -> float:
    begin = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = registered()
    seconds = {}
    for name in chosen:
        timed(queries[name], spark, folder)
        seconds[name] = round(
            statistics.median(timed(queries[name], spark, folder) for _ in range(runs)), 3
        )
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
