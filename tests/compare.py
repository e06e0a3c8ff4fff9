"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("num", v)
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", float(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return ("str", str(v))


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)
    return names, data


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return cols, cur.fetchall()


def compare(df, con, sql):
    """Return None when equal, else a short description of the difference."""
    sc, sr = normalise(*spark_rows(df))
    dc, dr = normalise(*duck_rows(con, sql))
    if sc != dc:
        return f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return f"row count differs: spark={len(sr)} duck={len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            return f"first differing row: spark={a} duck={b}"
    return None
