"""A fact in long form, one row per line and phase, and tables of any list of phases from it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PHASE = "phase"


def long_fact(lines: DataFrame, keys: list[str], phases: Mapping[str, str]) -> DataFrame:
    """Wide lines as keys, `phase` and `amount`; `phases` names the phase of each amount column."""
    renamed = lines.select(*keys, *[F.col(column).alias(name) for column, name in phases.items()])
    return renamed.unpivot(keys, list(phases.values()), PHASE, "amount")


def stacked_snapshots(snapshots: Mapping[str, DataFrame], keys: list[str]) -> DataFrame:
    """Rows of several snapshots of one table with the phase each comes from."""
    tagged = [df.select(*keys, F.lit(name).alias(PHASE)) for name, df in snapshots.items()]
    return reduce(DataFrame.unionByName, tagged)


def by_phase(
    fact: DataFrame, keys: list[str], phases: list[str], value: Column, base: str | None = None
) -> DataFrame:
    """One column per phase, in the order given, from a fact with any number of phases.

    `value` is an aggregate, such as a sum of amounts or a count of rows. Only the folders of these
    phases are read where the fact is stored by phase, and rows are aggregated by key and phase before
    the shuffle. A key that lacks a phase has NULL there; `base` keeps only the keys that phase has.
    """
    chosen = fact.filter(F.col(PHASE).isin(*phases))
    table = chosen.groupBy(*keys).pivot(PHASE, phases).agg(value)
    return table if base is None else table.filter(F.col(base).isNotNull())


def phase_change(table: DataFrame, start: str, end: str, name: str = "change") -> DataFrame:
    """The difference of two phases; a phase a key lacks counts as 0."""
    return table.withColumn(name, F.coalesce(end, F.lit(0)) - F.coalesce(start, F.lit(0)))
