"""Runs registered queries on Spark and their SQL on DuckDB and compares whole results."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os

import duckdb


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, str)):
        return value
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (dt.date, dt.datetime)):
        return f"date-like {value}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_normal(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> tuple[bool, str]:
    cursor = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got_cols, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if want_cols != got_cols:
        return False, f"columns differ: {sorted(set(want_cols) ^ set(got_cols))}"
    if len(want) != len(got):
        return False, f"rows: spark {len(got)}, sql {len(want)}"
    types_got = {c: {type(r[i]).__name__ for r in got} - {"NoneType"} for i, c in enumerate(got_cols)}
    types_want = {c: {type(r[i]).__name__ for r in want} - {"NoneType"} for i, c in enumerate(want_cols)}
    bad_types = {c: (types_got[c], types_want[c]) for c in got_cols if types_got[c] != types_want[c]}
    if bad_types:
        return False, f"types differ (spark, sql): {bad_types}"
    if want != got:
        pairs = [(g, w) for g, w in zip(got, want) if g != w]
        g, w = pairs[0]
        cells = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
        return False, f"{len(pairs)} rows differ; first (column, spark, sql): {cells[:6]}"
    return True, f"{len(got)} rows"
