"""Compares a query with its SQL in DuckDB, values without order."""

import glob
import os

import pandas as pd


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}{'/*' if os.path.isdir(p) else ''}')")
    return con


def rows(pdf):
    def plain(v):
        if pd.isna(v):
            return "~"
        if isinstance(v, pd.Timestamp):
            return str(v.tz_localize(None))
        return f"{v:.6f}" if isinstance(v, float) else str(v)

    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(map(plain, r)) for r in pdf.itertuples(index=False))


def assert_same(spark, con, sf_dir, query, sql):
    ours, theirs = query(spark, sf_dir).toPandas(), con.sql(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)
