"""Rows of a Spark frame and of DuckDB, in one notation."""

import datetime
import glob
import os

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def shown(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "null" if v != v else repr(v + 0.0)
    if isinstance(v, bool):
        return repr(v)
    if isinstance(v, int):
        return repr(float(v))
    if isinstance(v, datetime.datetime) and (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0):
        return repr(v.date())
    return repr(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())


def duck_rows(sql, folder):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{folder}/{t}.parquet"
        if glob.glob(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    r = con.sql(sql)
    cols = sorted(r.columns)
    at = [r.columns.index(c) for c in cols]
    return cols, sorted(tuple(shown(x[i]) for i in at) for x in r.fetchall())
