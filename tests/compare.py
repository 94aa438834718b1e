"""Runs a query and its SQL twin on the same tables and compares rows and columns."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        file = Path(sf_dir) / f"{name}.parquet"
        if file.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def difference(spark, con, run, sql: str, sf_dir: str) -> str | None:
    """None when both give the same rows, else what differs."""
    frame = run(spark, sf_dir)
    ours = _rows(frame.columns, frame.collect())
    twin = con.execute(sql)
    names = [d[0] for d in twin.description]
    theirs = _rows(names, twin.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}\n  spark {str(a)[:600]}\n  sql   {str(b)[:600]}"
    return None
