"""Joins in which both sides are large and may share a hot key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phasediff.operators import joins
from phasediff.operators.joins import estimated_bytes

#: Keys a task keeps track of while it measures, and keys that are treated as hot at most.
TRACKED = 8192
HOT_KEYS = 512


def heavy_keys(df: DataFrame, on: list[str]) -> tuple[int, dict[int, int]]:
    """Rows of a frame and about how many of them each frequent key has, by the hash of the key.

    Every task keeps a summary of TRACKED frequent keys, and the summaries are merged: what comes to
    the driver is HOT_KEYS numbers at most. Counts are short by less than 4 / TRACKED of all rows.
    """
    top = F.expr(f"approx_top_k(_key, {HOT_KEYS}, {TRACKED})")
    row = df.select(F.xxhash64(*on).alias("_key")).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return row["n"], {e["item"]: e["count"] for e in row["top"] or []}


def _splits(left: DataFrame, right: DataFrame, on: list[str], cells: int) -> list[tuple[int, int, int]]:
    """(hash, parts of the left, parts of the right) of keys with more than a cell's share of a side."""
    (n_left, of_left), (n_right, of_right) = heavy_keys(left, on), heavy_keys(right, on)
    share_left, share_right = max(1, n_left // cells), max(1, n_right // cells)
    found = []
    for key in of_left.keys() | of_right.keys():
        parts = math.ceil(of_left.get(key, 0) / share_left), math.ceil(of_right.get(key, 0) / share_right)
        if max(parts) > 1:
            found.append((key, max(1, parts[0]), max(1, parts[1])))
    return sorted(found)


def _part(df: DataFrame, parts: Column) -> Column:
    """The part a row goes to: the same when a task is repeated, different for equal rows of different tasks."""
    return F.pmod(F.hash(*df.columns).cast("bigint") + F.spark_partition_id(), parts)


def skew_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", cells: int | None = None
) -> DataFrame:
    """Equi join that may fan out, with hot keys dealt to a grid of tasks.

    A right side under the broadcast limit is broadcast. Otherwise the keys of both sides are measured.
    A key with more than 1 / cells of the rows of a side has that side cut into parts and the other side
    copied to each part; all other rows are neither salted nor copied. A copy of a left row meets a
    different part of the right rows each time, so every pair of rows is joined once.

    `cells` is the number of shuffle partitions unless given. NULL keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join keeps the left side: use 'inner' or 'left'")
    spark = left.sparkSession
    size = estimated_bytes(right)
    if size is not None and size <= joins.BROADCAST_LIMIT_BYTES:
        return left.join(F.broadcast(right), on, how)
    cells = cells or int(spark.conf.get("spark.sql.shuffle.partitions"))
    right = right.dropna(subset=on)
    hot = _splits(left, right, on, cells)
    if not hot:
        return left.join(right, on, how)

    values = ", ".join(f"({k}L, {a}, {b})" for k, a, b in hot)
    table = F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t(_key, _left_parts, _right_parts)"))

    def measured(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", F.xxhash64(*on)).join(table, "_key", "left").drop("_key")

    def copies(parts: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1))

    of_left, of_right = F.coalesce("_left_parts", F.lit(1)), F.coalesce("_right_parts", F.lit(1))
    rights = measured(right)
    # keys whose right rows are cut: a left row with such a key has a match in at least one part
    cut = rights.filter(of_right > 1).select(*on).distinct().withColumn("_cut", F.lit(True))
    lefts = measured(left).join(F.broadcast(cut), on, "left")
    met = F.when(F.col("_cut"), of_right).otherwise(F.lit(1))
    lefts = lefts.withColumns({"_i": _part(left, of_left), "_copies": met}).withColumn("_j", copies(F.col("_copies")))
    rights = rights.withColumns({"_j": _part(right, of_right)}).withColumn("_i", copies(of_left))
    kept = [c for c in right.columns if c not in on]
    rights = rights.select(*on, "_i", "_j", *kept, F.lit(True).alias("_met"))
    joined = lefts.select(*left.columns, "_i", "_j", "_copies").join(rights, [*on, "_i", "_j"], how)
    return joined.filter((F.col("_copies") == 1) | F.col("_met")).select(
        *on, *[c for c in left.columns if c not in on], *kept
    )
