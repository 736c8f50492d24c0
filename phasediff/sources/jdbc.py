"""Relational source."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    user_variable: str = "FINANCE_DB_USER",
    password_variable: str = "FINANCE_DB_PASSWORD",
) -> dict[str, str]:
    """Options of a JDBC read; credentials come from the environment.

    With a numeric partition column and its bounds the table is read by several tasks, each with
    a range of its own. The bounds only cut the ranges, rows outside them are read as well.
    """
    options = {"url": url, "dbtable": table, "fetchsize": "10000"}
    for key, variable in (("user", user_variable), ("password", password_variable)):
        if os.environ.get(variable):
            options[key] = os.environ[variable]
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partitioned read needs the bounds of its column")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **parts) -> DataFrame:
    """A table of a relational database; Spark pushes filters and columns down to it."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **parts)).load()


def bound_table(spark: SparkSession, name: str, where: str = "TRUE", **values) -> DataFrame:
    """A table or view whose name and values are bound as parameters, never put into the statement.

    `where` may use `:name` for each of the values. A name that is none is refused by the binder.
    """
    return spark.sql(f"SELECT * FROM IDENTIFIER(:source_table) WHERE {where}", args={"source_table": name, **values})


def phase_tables(spark: SparkSession, stem: str, phases: list[str], where: str = "TRUE", **values) -> DataFrame:
    """The tables of several phases (`stem_phase`), stacked, with the phase of each row."""
    tables = [bound_table(spark, f"{stem}_{p}", where, **values).withColumn("phase", F.lit(p)) for p in phases]
    return reduce(DataFrame.unionByName, tables)


def phase_table(schema: str, stem: str, phase: str | None = None) -> str:
    """Name of a finance table, some of which exist once per phase."""
    name = stem if phase is None else f"{stem}_{phase}"
    for part in (schema, name):
        if not part.replace("_", "").isalnum():
            raise ValueError(f"not a table name: {part!r}")
    return f"{schema}.{name}"
