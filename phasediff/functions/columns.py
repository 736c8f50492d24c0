"""Small column expressions shared by the plans; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def sum0(col: str | Column) -> Column:
    """Sum that ignores NULLs and is 0, not NULL, for a group without values."""
    total = F.sum(F.col(col) if isinstance(col, str) else col)
    return F.coalesce(total, F.lit(0))


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; NULL when the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent_text(value: Column, digits: int = 1) -> Column:
    """``0.1234`` -> ``12.3%``."""
    return F.concat(F.format_number(value * 100, digits), F.lit("%"))


def upper_first(text: Column) -> Column:
    """Capitalise the first letter and leave the rest alone."""
    return F.concat(F.upper(F.substr(text, F.lit(1), F.lit(1))), F.substr(text, F.lit(2)))


def drop_last(text: Column, word: str) -> Column:
    """Remove the last occurrence of a plain word (letters only)."""
    return F.regexp_replace(text, f"(?s)^(.*){word}", "$1")


def sql_literal(value) -> str:
    return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def case_sql(value: str, mapping: Mapping, default: str = "NULL") -> str:
    """SQL of a constant code table: one CASE instead of a join; tuple keys list several codes."""
    branches = []
    for key, result in mapping.items():
        codes = ", ".join(sql_literal(k) for k in (key if isinstance(key, tuple) else (key,)))
        branches.append(f"WHEN {value} IN ({codes}) THEN {sql_literal(result)}")
    return f"CASE {' '.join(branches)} ELSE {default} END"


def lookup(value: str, mapping: Mapping, default: str = "NULL") -> Column:
    return F.expr(case_sql(value, mapping, default))


def position_in(value: str, ordered: Iterable[str]) -> Column:
    """Sort ordinal of a listed value; a NULL follows the list, anything else comes last."""
    ordered = list(ordered)
    ranks = {name: i for i, name in enumerate(ordered, start=1)}
    missing, other = len(ordered) + 1, len(ordered) + 2
    return F.expr(case_sql(value, ranks, f"IF({value} IS NULL, {missing}, {other})"))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def zero_filled(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.expr(f"coalesce({c}, 0)") for c in columns})
