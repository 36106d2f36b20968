"""Compares a query with its SQL on DuckDB, as sets of rows with repeats."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir, f"{t}.parquet")
        if p.exists():
            con.sql(f"create view {t} as select * from '{p if p.is_file() else p / '*.parquet'}'")
    return con


def canon(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str([canon(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


def rows(df) -> list[tuple]:
    cols = sorted(df.columns)
    return sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())


def sql_rows(con, sql: str, columns: list[str]) -> list[tuple]:
    rel = con.sql(sql)
    assert sorted(rel.columns) == sorted(columns)
    at = [rel.columns.index(c) for c in sorted(columns)]
    return sorted(tuple(canon(r[i]) for i in at) for r in rel.fetchall())
