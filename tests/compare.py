"""Run registered queries beside their SQL and compare, order-insensitively."""

from __future__ import annotations

import datetime as dt
import glob
import os
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    if isinstance(value, float):
        return ("f", repr(value))
    if isinstance(value, bool):
        return ("b", str(value))
    if isinstance(value, int):
        return ("i", str(value))
    return (type(value).__name__, str(value))


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_result(df):
    return table_of(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cur = con.execute(sql)
    return table_of([d[0] for d in cur.description], cur.fetchall())
