"""Compare a Spark result with a DuckDB result: names, row count, and values as multisets of rows."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return v + 0.0
    return v


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    mine, theirs = _table(df.columns, [tuple(r) for r in df.collect()]), _table(names, result.fetchall())
    if len(mine) != len(theirs):
        return [f"rows {len(mine)} vs {len(theirs)}"]
    out = [f"{a} vs {b}" for a, b in zip(mine, theirs) if a != b]
    kinds = [f"types {[type(x).__name__ for x in a]} vs {[type(x).__name__ for x in b]}" for a, b in zip(mine[:1], theirs[:1])
             if any(type(x) is not type(y) and x is not None and y is not None for x, y in zip(a, b))]
    return kinds + ([f"{len(out)} rows differ", *out[:2]] if out else [])
