"""Ordinals of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phasediff.operators.joins import lookup_join
from phasediff.operators.scratch import materialize

#: Rows of one task have ids below this one, see monotonically_increasing_id().
_IDS_OF_A_TASK = 1 << 33


def numbered_within(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Every row with its number from 1 on within its group, in ascending order with NULLs last.

    A row number over a window would bring a whole group to one task. Here rows are range partitioned
    and sorted by group and order, so a large group lies in consecutive pieces. The pieces are stored,
    the rows of each are counted, and a row's number is its place in the piece plus the rows of the
    pieces before. Only counts meet in one place: a row for each group and piece.

    Group and order together should tell all rows apart; rows that tie are numbered in any order.
    """
    keys = [F.col(c).asc_nulls_last() for c in [*group, *order]]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = ranged.withColumn("_at", F.monotonically_increasing_id())
    stored = materialize(placed, "numbered").withColumns(
        {"_piece": F.expr(f"_at div {_IDS_OF_A_TASK}"), "_group": F.struct(*group)}
    )
    pieces = stored.groupBy("_group", "_piece").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")
    )
    earlier = Window.partitionBy("_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    shifts = pieces.select("_group", "_piece", (before + 1 - F.col("_first")).alias("_shift"))
    numbered = lookup_join(stored, shifts, ["_group", "_piece"])
    return numbered.withColumn(name, F.col("_at") + F.col("_shift")).select(*df.columns, name)
