"""Compare a Spark result with its SQL oracle, as sets of rows."""

from __future__ import annotations

import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            table = name.removesuffix(".parquet")
            db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def mismatch(df, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = _rows(names, result.fetchall())
    got = _rows(df.columns, df.collect())
    if len(want) != len(got):
        return f"{len(got)} rows, oracle has {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
