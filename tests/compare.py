"""Rows of a query against those of its SQL."""

import math
import os

import duckdb


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return str(v) if not isinstance(v, int) else v


def same_rows(df, sql, sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    found = con.sql(sql)
    columns = sorted(df.columns)
    assert columns == sorted(found.columns)
    a = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    b = sorted(repr([plain(v) for v in row]) for row in found.select(*(f'"{c}"' for c in columns)).fetchall())
    assert a == b
