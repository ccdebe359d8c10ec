"""Runs a query and its SQL side by side."""

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    db = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        where = f"{f}/*.parquet" if os.path.isdir(f) else f
        db.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{where}')")
    return db


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(df, db, sql):
    found = db.execute(sql)
    want_names, want = rows([d[0] for d in found.description], found.fetchall())
    names, got = rows(df.columns, df.collect())
    assert names == want_names
    more, less = got - want, want - got
    assert not more and not less, f"{sum(more.values())} rows too many, such as {list(more)[:2]}; {sum(less.values())} missing, such as {list(less)[:2]}"
    return sum(got.values())
