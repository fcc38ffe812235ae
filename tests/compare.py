"""Rows of a Spark query against those of its DuckDB equivalent."""

import os

import duckdb

SF = "/root/testdata/sf0.001"


def _plain(v):
    if isinstance(v, float):
        return "%.9g" % v
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    return v


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, sorted(repr([_plain(r[c]) for c in columns]) for r in df.collect())


def duck_rows(sql, sf_dir=SF):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted(names), sorted(repr([_plain(r[i]) for i in order]) for r in cur.fetchall())
