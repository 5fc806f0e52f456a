"""Compares a query's rows with those of its SQL in DuckDB, whatever their order."""

import glob
import math
import os

import duckdb


def views(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else str(round(v, 9)) if v != int(v) else str(int(v))
    return str(v)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in values)


def same(df, con, sql):
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    assert sorted(names) == sorted(df.columns)
    want, have = rows(names, got.fetchall()), rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(want) == len(have)
    for a, b in zip(have, want):
        assert a == b
