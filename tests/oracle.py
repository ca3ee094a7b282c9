"""Runs a query's SQL in DuckDB and compares rows whatever their order."""

import datetime
import glob
import os

import duckdb


def plain(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def check(df, sql, sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall()), key=repr)
    assert got == want
