"""Run a Spark query and its DuckDB statement side by side and compare them value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from vitalframe.sources.fixtures import SHARED_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in SHARED_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value: object) -> object:
    """One comparable form for values that both engines may type differently."""
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        f = float(value)
        return "nan" if math.isnan(f) else round(f, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if hasattr(value, "asDict"):
        return tuple(plain(v) for v in value.asDict().values())
    if isinstance(value, dict):
        return tuple(plain(v) for v in value.values())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return str(value)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names, row count and all values agree; else a short list of differences."""
    result = con.execute(sql)
    their_names = [d[0] for d in result.description]
    theirs = result.fetchall()
    names = sorted(df.columns)
    if names != sorted(their_names):
        return [
            f"only in Spark: {sorted(set(names) - set(their_names))}; "
            f"only in SQL: {sorted(set(their_names) - set(names))}"
        ]
    ours = df.select(*[f"`{n}`" for n in names]).collect()
    order = [their_names.index(n) for n in names]
    a = [tuple(plain(v) for v in row) for row in ours]
    b = [tuple(plain(row[i]) for i in order) for row in theirs]
    if len(a) != len(b):
        return [f"rows: Spark {len(a)}, SQL {len(b)}"]
    if Counter(a) == Counter(b):
        return []
    problems = []
    for i, name in enumerate(names):
        ca, cb = Counter(r[i] for r in a), Counter(r[i] for r in b)
        if ca != cb:
            more, less = (ca - cb).most_common(3), (cb - ca).most_common(3)
            problems.append(f"{name}: Spark has more of {more}, SQL has more of {less}")
    return problems or ["same column contents, but rows differ in combination"]
