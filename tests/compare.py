"""Comparison of a Spark result with the result of SQL in DuckDB."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canon(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime | date):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def canon_rows(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(tuple(canon(row[at]) for at in order) for row in rows)


def spark_rows(df):
    return canon_rows(df.columns, df.collect())


def sql_rows(con, sql):
    done = con.execute(sql)
    names = [column[0] for column in done.description]
    return canon_rows(names, done.fetchall()), sorted(names)
