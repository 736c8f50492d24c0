"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a folder in the warehouse where it is unset."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return spark.conf.get("spark.checkpoint.dir", None) or f"{warehouse}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/phasediff/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a small aggregate once and read it back.

    For results that several branches of a plan need: Spark would otherwise repeat the scan of
    the large input per branch, because each branch prunes other columns and the exchanges are
    no longer equal. The written table also survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
