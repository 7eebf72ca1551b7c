"""Holding a query against its SQL on the smallest tables."""

import glob
import math
import os
from collections import Counter

DATA = "/root/testdata/sf0.001"


def connect():
    import duckdb

    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T00:00:00", "").replace("+00:00", "")
    if hasattr(v, "tolist") or isinstance(v, list):
        return tuple(plain(x) for x in v)
    return v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in values)


def same(spark, con, query, sql):
    df = query(spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    c = con.execute(sql)
    due = rows([d[0] for d in c.description], c.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in c.description)
    assert got == due, (list((got - due).items())[:3], list((due - got).items())[:3])
