"""Run a registered query and its oracle SQL over the same tables and compare all values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: [(v is None, str(type(v)), v) for v in row]
    return sorted(columns), sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=lambda r: repr(key(r)))


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    found = con.execute(sql)
    return _sorted_rows([d[0] for d in found.description], found.fetchall())
