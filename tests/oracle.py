"""Holding a query against its SQL: the rows of both, by value."""

from __future__ import annotations

import datetime
import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def connection(sf_dir: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "as_tuple"):
        return round(float(v), 6) + 0.0
    return v


def rows(names: list[str], values) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in values)


def differences(spark, con, f, sql: str, sf_dir: str = SF) -> str:
    df = f(spark, sf_dir)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    theirs = rows([c[0] for c in cur.description], cur.fetchall())
    if sorted(df.columns) != sorted(c[0] for c in cur.description):
        return f"columns {sorted(df.columns)} and {sorted(c[0] for c in cur.description)}"
    if mine != theirs:
        return f"{sum(mine.values())} and {sum(theirs.values())} rows; only here {list((mine - theirs).items())[:3]}; only there {list((theirs - mine).items())[:3]}"
    return ""
