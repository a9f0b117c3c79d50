"""Runs registered queries against their SQL on the same tables and compares all values."""

from __future__ import annotations

import math
import os

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')" if os.path.isfile(path) else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return con


def canon(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(canon, v)) + "]"
    return str(int(v)) if hasattr(v, "item") and isinstance(v.item(), int) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def difference(spark, sf_dir: str, name: str, query, sql: str) -> str:
    """Empty if query and SQL give the same rows."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = connection(sf_dir).execute(sql)
    columns = [d[0] for d in res.description]
    want = rows_of(columns, res.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"{name}: columns {sorted(df.columns)} and {sorted(columns)}"
    if got != want:
        a, b = [r for r in got if r not in set(want)][:3], [r for r in want if r not in set(got)][:3]
        return f"{name}: {len(got)} and {len(want)} rows; only Spark {a}; only SQL {b}"
    return ""
