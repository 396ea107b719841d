"""Compares a query with its SQL in DuckDB over the same tables."""

import math
from pathlib import Path

import duckdb

SF_DIR = Path("/root/testdata/sf0.001")


def connection():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in SF_DIR.iterdir():
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6g}"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def check(spark, query, sql):
    df = query(spark, str(SF_DIR))
    cursor = connection().execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
