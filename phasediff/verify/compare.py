"""Compare a Spark result with its SQL oracle, ignoring row and column order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        x = float(v)
        return None if math.isnan(x) else float(f"{x:.9g}") + 0.0
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else v


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides have the same columns and the same bag of rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark {sorted(df.columns)} oracle {sorted(names)}"]
    expected = _bag(names, cursor.fetchall())
    found = _bag(df.columns, df.collect())
    if expected == found:
        return []
    return [
        f"rows: spark {sum(found.values())} oracle {sum(expected.values())}",
        *[f"only spark: {r}" for r in list((found - expected).elements())[:2]],
        *[f"only oracle: {r}" for r in list((expected - found).elements())[:2]],
    ]
