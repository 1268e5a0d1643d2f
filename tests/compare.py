"""Compares a Spark result with the DuckDB result of the same query."""

from __future__ import annotations

import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=repr)
    return [names[i] for i in order], rows
