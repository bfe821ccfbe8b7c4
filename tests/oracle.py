"""Compare a Spark query with its SQL on the same tables, as multisets of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

from conftest import TABLES


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """Spark and SQL rows that the other side does not have, and the row count."""
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    sql_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    ours, theirs = multiset(df.columns, spark_rows), multiset(names, sql_rows)
    return ours - theirs, theirs - ours, len(spark_rows), sql_rows
