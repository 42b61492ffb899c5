"""Runs registered queries against DuckDB on the same Parquet files."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    return value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duckdb_result(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), rows_of(columns, cur.fetchall())
