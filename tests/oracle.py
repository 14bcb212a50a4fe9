"""Side-by-side run of a registered query and its SQL twin."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def _sorted_rows(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def spark_rows(df):
    names = sorted(df.columns)
    return names, _sorted_rows(df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), _sorted_rows([tuple(row[i] for i in order) for row in cursor.fetchall()])


def difference(con, sql, df):
    """None when both sides agree, else a short description."""
    left_names, left = spark_rows(df)
    right_names, right = duck_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}; spark {left[:2]} duck {right[:2]}"
    types = [(a, b) for row_a, row_b in zip(left, right) for a, b in zip(row_a, row_b)
             if a is not None and b is not None and type(a) is not type(b)]
    if types:
        return f"types differ: {types[:3]}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ: {wrong[:2]}" if wrong else None
