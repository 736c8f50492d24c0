"""Presentation order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def presentation_sort(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Global order for a final report, NULLs last.

    Rows with equal keys would all meet in one range partition, so the number of the task that
    produced a row is the last sort key: a large group of ties is spread over several partitions.
    """
    ordered = [k if isinstance(k, Column) else F.col(k).asc_nulls_last() for k in keys]
    return df.withColumn("_tie", F.spark_partition_id()).orderBy(*ordered, "_tie").drop("_tie")
