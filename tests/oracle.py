"""Compare a registered query with its SQL counterpart in DuckDB."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def kind(value) -> str:
    return type(value).__name__


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, row count and every value agree exactly."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(names, found.fetchall())
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    problems = [f"{a} != {b}" for a, b in zip(ours, theirs, strict=True) if a != b]
    types = [
        f"types {[kind(v) for v in a]} != {[kind(v) for v in b]}"
        for a, b in zip(ours[:1], theirs[:1], strict=True)
        if [kind(v) for v in a] != [kind(v) for v in b]
    ]
    return problems + types
