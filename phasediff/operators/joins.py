"""Joins used by more than one plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024
SALTS = 16


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan; None when the session does not expose it."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except AttributeError:
        return None


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    dim_bytes: int | None = None,
    limit_bytes: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Attach dimension columns to a large frame whose keys may be heavily skewed.

    A dimension whose estimated size is under the limit is broadcast, so the fact side is not
    shuffled. A larger or unmeasured one is copied once per salt and joined on (key, salt):
    the rows of a hot key go to ``salts`` reducers, every row still meets exactly one copy.
    The salt is the number of the task that read the row, which a retried task repeats; it does
    not depend on row contents, so groups of identical rows are split too.

    ``dim_bytes`` is a bound the caller knows, for dimensions that are joins themselves: the
    estimate of a join is the product of its inputs, far above the real size.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join keeps the fact side: use 'inner' or 'left'")
    limit = BROADCAST_LIMIT_BYTES if limit_bytes is None else limit_bytes
    size = estimated_bytes(dim) if dim_bytes is None else dim_bytes
    if size is not None and size <= limit:
        return fact.join(F.broadcast(dim), on, how)
    salted_fact = fact.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_fact.join(salted_dim, [*on, "_salt"], how).drop("_salt")


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi join in which NULL keys match each other; the left side's keys are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    joined = left.join(renamed, null_safe_condition(on), how)
    return joined.drop(*[f"_r_{k}" for k in on])


def null_safe_condition(on: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in on])
