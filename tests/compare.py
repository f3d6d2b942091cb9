"""Runs a registered query and its SQL side by side and compares all values."""

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(x):
    if x is None:
        return None
    if isinstance(x, float):
        return None if math.isnan(x) else x
    if isinstance(x, datetime.datetime | datetime.date):
        return x.isoformat()
    if isinstance(x, list | tuple):
        return tuple(_cell(y) for y in x)
    return x


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(table, key=repr)


def duck(con, sql):
    con.execute(sql)
    names = [d[0] for d in con.description]
    kinds = {d[0]: str(d[1]) for d in con.description}
    return *normal(names, con.fetchall()), kinds


def difference(frame, con, sql):
    """None when equal, else a short text."""
    names, rows = normal(frame.columns, [tuple(row) for row in frame.collect()])
    sql_names, sql_rows, _ = duck(con, sql)
    if names != sql_names:
        return f"columns {names} against {sql_names}"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} rows against {len(sql_rows)}"
    types = {type(x).__name__ for row in rows for x in row if x is not None}
    if "Decimal" in types or any(type(x).__name__ == "Decimal" for row in sql_rows for x in row):
        return "decimal values; cast them"
    for a, b in zip(rows, sql_rows):
        if [(type(x), x) for x in a] != [(type(x), x) for x in b]:
            off = [(n, x, y) for n, x, y in zip(names, a, b) if (type(x), x) != (type(y), y)]
            return f"first difference {off[:4]} in {a}"
    return None
