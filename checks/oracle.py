"""Compare a query with its SQL: column names, types in the large, every value."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v) -> str:
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, Decimal):
        return f"decimal:{v}"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return str(v)


def compare(df, sql: str, con) -> str | None:
    """None when equal, else what differs first."""
    names = sorted(df.columns)
    got = sorted(tuple(_cell(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    rel = con.execute(sql)
    theirs = [d[0] for d in rel.description]
    if sorted(theirs) != names:
        return f"columns {names} != {sorted(theirs)}"
    at = [theirs.index(n) for n in names]
    want = sorted(tuple(_cell(row[i]) for i in at) for row in rel.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            bad = [f"{n}: {a} != {b}" for n, a, b in zip(names, g, w) if a != b]
            return "; ".join(bad)[:400] + f" (row {g})"[:300]
    return None
