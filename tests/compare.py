"""Order-insensitive comparison of a Spark frame with SQL run by DuckDB."""

import datetime
import decimal
import math
import os

import duckdb


def norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows(df):
    names = sorted(df.columns)
    return sorted((tuple(norm(r[c]) for c in names) for r in df.collect()), key=repr)


def expected(sql, sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    found = con.sql(sql)
    at = [found.columns.index(c) for c in sorted(found.columns)]
    return sorted(found.columns), sorted((tuple(norm(r[i]) for i in at) for r in found.fetchall()), key=repr)
