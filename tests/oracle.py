"""Compare a registered query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((v is not None, str(type(v).__name__ in ("int", "float")), f"{v:.6f}" if isinstance(v, float) else str(v)) for v in row)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else a short account of the first difference."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    a = sorted((tuple(_cell(r[c]) for c in order) for r in got), key=_key)
    pos = [names.index(c) for c in order]
    b = sorted((tuple(_cell(r[i]) for i in pos) for r in want), key=_key)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        for c, u, v in zip(order, x, y):
            if u == v and type(u) is type(v):
                continue
            return f"{c}: {u!r} != {v!r} in {x} / {y}"
    return None
