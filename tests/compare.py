"""Compare a Spark result with a DuckDB result: columns by name, rows in any order."""

import datetime
import math
from pathlib import Path

import duckdb

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted([tuple(plain(row[i]) for i in order) for row in rows])


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return normal([d[0] for d in result.description], result.fetchall())
