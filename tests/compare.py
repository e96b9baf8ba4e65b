"""Rows of a frame against rows of a DuckDB query on the same tables."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb


def connect(base: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(base).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 4) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 4) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def counted(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(frame, con, sql: str):
    """(columns that differ, rows only in Spark, rows only in SQL)."""
    theirs = con.execute(sql)
    names = [d[0] for d in theirs.description]
    want = counted(names, theirs.fetchall())
    got = counted(frame.columns, [tuple(r) for r in frame.collect()])
    return sorted(set(names) ^ set(frame.columns)), list((got - want).items())[:5], list((want - got).items())[:5]
