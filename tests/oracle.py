"""Order-insensitive comparison of a Spark result with DuckDB."""

import glob
import math
import os

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def compare(df, con, sql):
    """(columns, rows) of both sides, ready for equality."""
    cursor = con.execute(sql)
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    return _rows(df.columns, [tuple(r) for r in df.collect()]), theirs
