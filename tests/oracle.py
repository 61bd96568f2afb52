"""Compares a query with its SQL in DuckDB, rows in any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def _plain(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else None
    return v


def rows_of(names, tuples):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(t[i]) for i in order) for t in tuples), key=repr)


def compare(spark, query, sql, sf_dir: Path):
    df = query(spark, str(sf_dir))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    for p in sf_dir.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    found = con.execute(sql)
    want = rows_of([c[0] for c in found.description], found.fetchall())
    assert sorted(df.columns) == sorted(c[0] for c in found.description)
    assert len(got) == len(want) > 0
    bad = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    assert not bad, bad[:3]
