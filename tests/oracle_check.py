"""Compare a registered query with its reference SQL, row by row and in no order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v) for v in row)


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=_key)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """The row count and a list of differences (empty when equal)."""
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(mine), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(mine) != len(theirs):
        return len(mine), [f"rows {len(mine)} != {len(theirs)}"]
    columns = sorted(names)
    problems = []
    for a, b in zip(mine, theirs):
        for name, x, y in zip(columns, a, b):
            if not same(x, y):
                problems.append(f"{name}: {x!r} != {y!r} in {a}")
        if len(problems) > 5:
            break
    return len(mine), problems
