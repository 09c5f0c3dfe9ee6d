"""Runs a query and its SQL side by side and compares row counts, names and values in any order."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _plain(x):
    if isinstance(x, float):
        return "nan" if x != x else round(x, 9)
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, int):
        return float(x)
    return x


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> None:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    want = rows_of(names, got.fetchall())
    have = rows_of(df.columns, df.collect())
    assert sorted(names) == sorted(df.columns), (names, df.columns)
    assert len(have) == len(want), (len(have), len(want))
    for a, b in zip(have, want, strict=True):
        assert a == b, (a, b)
