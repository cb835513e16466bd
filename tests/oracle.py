"""Compare a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    return value


def _key(row):
    return tuple((v is not None, str(type(v)), v) if v is not None else (False, "", 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=_key), [columns[i] for i in order]


def compare(df, sql: str, con) -> list[str]:
    """Differences between the two results; empty if they are equal."""
    got, got_names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    want, want_names = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return [f"columns {got_names} != {want_names}"]
    problems = []
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} rows differ")
        for g, w in bad[:3]:
            problems.append(str([(n, x, y) for n, x, y in zip(got_names, g, w) if x != y]))
    return problems
